"""Secret scans: a trigram inverted index prunes documents for each rule, then its regex verifies candidates.

DataFrame functions only. Each rule's regex is turned into a Boolean trigram query: alternatives of mandatory
literals, cut into trigrams of lower-cased text. The index holds, for the trigrams that any query names, the
documents with them; postings are intersected within each alternative. A rule with an alternative that has no
mandatory trigram scans every document.

A text of any length is scanned whole; rows that repeat are scanned one by one; an empty table gives an empty table.
Offsets are code points, end exclusive; matches of a kind are leftmost and don't overlap, and those under the
rule's least length are dropped after matching. Null texts are empty and have no span. Documents are matched to
postings by doc_id; where it repeats, candidates of one row count for its namesakes too, and verification is exact.
"""

from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avmatch.llm import bitmaps
from avmatch.llm.store import stash

#: (kind, pattern, group whose length counts, least length). The first three are the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = [
    ("assign", ASSIGN, 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("hub", "gh[opsru]_[A-Za-z0-9]{30,}", 0, 1),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
]
BASE = 3
#: Matches that are placed together; what is done for them grows with their number times this.
CHUNK = 256
#: Strings that a run of small classes may stand for, before it counts as unknown.
SPELT = 16


def alternatives(pattern: str) -> list[set[str]]:
    """Mandatory literals of each alternative of a regex, lower-cased: one of these sets must be in any match."""

    def walk(nodes) -> list[list[str | None]]:
        """Alternatives as sequences of literals; None stands for anything."""
        out: list[list[str | None]] = [[""]]

        def then(tails: list[list[str | None]]) -> None:
            nonlocal out
            joined = []
            for a in out:
                for b in tails:
                    both = a[-1] is not None and b[0] is not None
                    joined.append([*a[:-1], a[-1] + b[0], *b[1:]] if both else [*a, *b])
            out = joined if len(joined) <= SPELT * 4 else [[None]]

        for op, arg in nodes:
            if op is C.LITERAL:
                then([[chr(arg).lower()]])
            elif op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= SPELT:
                then([[chr(x).lower()] for _, x in arg])
            elif op is C.SUBPATTERN:
                then(walk(arg[3]))
            elif op is C.BRANCH:
                then([x for part in arg[1] for x in walk(part)])
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] >= 1:
                once = walk(arg[2])
                then([[*x, None] for x in once] if arg[1] > 1 else once)
            elif op is not C.AT:
                then([[None]])
        return out

    return [{x for x in seq if x} for seq in walk(_parser.parse(pattern))]


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Sets of trigrams, one of which a match must contain whole; None if some match needs no trigram."""
    sets = []
    for literals in alternatives(pattern):
        found = {x[k : k + 3] for x in literals for k in [*range(0, len(x) - 2, 3), len(x) - 3] if len(x) >= 3}
        if not found:
            return None
        sets.append(frozenset(found))
    return list(dict.fromkeys(sets))


def candidates(docs: DataFrame, rules) -> DataFrame:
    """(key, rules): the documents whose postings satisfy each rule's query, by the index."""
    clauses = [(k, n, t, len(s)) for n, rule in enumerate(rules) for k, s in enumerate(trigram_query(rule[1]) or []) for t in sorted(s)]
    grams = sorted({t for _, _, t, _ in clauses})
    quote = lambda t: "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"
    table = docs.sparkSession.sql("select * from values " + ", ".join(f"({k}, {n}, {quote(t)}, {need})" for k, n, t, need in clauses) + " as q(clause, rule, gram, need)")
    low = docs.select("key", F.lower("text").alias("low"))
    held = low.select("key", F.array_compact(F.array(*(F.when(F.col("low").contains(t), t) for t in grams))).alias("grams"))
    # An outer explode: a plain one infers a filter on its array, which would find every trigram once more.
    postings = held.select("key", F.explode_outer("grams").alias("gram"))
    met = postings.join(F.broadcast(table), "gram").groupBy("key", "rule", "clause", "need").agg(F.count_distinct("gram").alias("n"))
    return met.where("n = need").groupBy("key").agg(F.collect_set("rule").alias("rules"))


def let(value: Column, use) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_chunks(rows: Column, use) -> Column:
    """[use(chunk)] of an array in chunks of CHUNK: arrays that grow row by row are copied with each row, so they are
    built by chunk and joined once."""
    last = F.floor((F.greatest(F.size(rows), F.lit(1)) - 1) / CHUNK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: use(F.slice(rows, i * CHUNK + 1, F.lit(CHUNK))))


def spans(text: Column, rule) -> Column:
    """array<struct<start, kind order, stop, kind>> of one rule's matches."""
    kind, pattern, group, least = rule
    order = [r[0] for r in RULES].index(kind) if kind in [r[0] for r in RULES] else len(RULES)
    p = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, p, F.lit(0)), F.length)
    part = F.transform(F.regexp_extract_all(text, p, F.lit(group)), F.length) if group else whole
    rows = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), part.alias("part"))
    empty = F.array().cast("array<struct<start: int, rank: int, stop: int, kind: string>>")

    def step(at: Column, row: Column) -> Column:
        start = at["at"] + row["gap"]
        stop = start + F.coalesce(row["whole"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("rank"), stop.alias("stop"), F.lit(kind).alias("kind"))
        return F.struct(stop.alias("at"), F.when(row["part"] >= least, F.concat(at["out"], F.array(span))).otherwise(at["out"]).alias("out"))

    def placed(at: Column, chunk: Column) -> Column:
        moved = F.transform(chunk["out"], lambda s: F.struct((s["start"] + at["at"]).alias("start"), s["rank"].alias("rank"), (s["stop"] + at["at"]).alias("stop"), s["kind"].alias("kind")))
        return F.struct((at["at"] + chunk["at"]).alias("at"), F.concat(at["out"], F.array(moved)).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    chunks = let(rows, lambda r: in_chunks(r, lambda c: F.aggregate(c, begin, step)))
    found = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start: int, rank: int, stop: int, kind: string>>>").alias("out")), placed)
    return F.when(text.rlike(pattern), F.flatten(found["out"])).otherwise(empty)


def masked(text: Column, found: Column, mark: str) -> Column:
    """text with each of the spans, in order, replaced by a mark; one that begins within those before it is covered."""

    def step(at: Column, span: Column) -> Column:
        before = at["part"].substr(at["at"] - at["base"] + 1, F.greatest(span["start"] - at["at"], F.lit(0)))
        more = F.concat(at["out"], F.array(before, F.lit(mark)))
        now = [F.greatest(span["stop"], at["at"]).alias("at"), F.when(span["start"] >= at["at"], more).otherwise(at["out"]).alias("out")]
        return F.struct(*now, at["base"].alias("base"), at["part"].alias("part"))

    def piece(state: Column, chunk: Column) -> Column:
        """The chunk's stretch of the text is cut out once; its spans are found within it."""
        stop = F.greatest(F.array_max(F.transform(chunk, lambda s: s["stop"])), state["at"])
        begin = F.struct(state["at"].alias("at"), F.array().cast("array<string>").alias("out"), state["at"].alias("base"), text.substr(state["at"] + 1, stop - state["at"]).alias("part"))
        return let(F.aggregate(chunk, begin, step), lambda done: F.struct(done["at"].alias("at"), F.concat(state["out"], F.array(F.array_join(done["out"], ""))).alias("out")))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    whole = let(F.aggregate(in_chunks(found, lambda c: c), begin, piece), lambda done: F.concat(F.array_join(done["out"], ""), text.substr(done["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, whole).otherwise(text)


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """docs (doc_id, text, ...) and spans: array<struct<start, rank, stop, kind>> of all rules, by start, then rule.

    Only documents that may be candidates meet the postings; other texts stay where they are.
    """
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    found = stash(candidates(docs.select(key.alias("key"), F.coalesce("text", F.lit("")).alias("text")), rules), "candidates")
    some, rest = bitmaps.split(docs.withColumn("_key", key), "_key", found.select("key"))
    some = some.join(found.select(F.col("key").alias("_key"), F.col("rules").alias("_rules")), "_key", "left")
    text = F.coalesce("text", F.lit(""))
    none = F.array().cast("array<struct<start: int, rank: int, stop: int, kind: string>>")
    full = [trigram_query(r[1]) is None for r in rules]

    def verified(rows: DataFrame, hits: bool) -> DataFrame:
        each = [spans(text, r) if every else F.when(F.array_contains("_rules", n), spans(text, r)).otherwise(none) for n, (r, every) in enumerate(zip(rules, full, strict=True)) if every or hits]
        return rows.select(*docs.columns, F.sort_array(F.concat(none, *each)).alias("spans"))

    return verified(some, True).unionByName(verified(rest, False))


def listed(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
