"""Entity resolution and N-number repairs as if rows came one by one, against loops over rows."""

import random

import pytest
from pyspark.sql import functions as F

from avmatch.operators import ordered, repair, resolve


def loop(records, entities, fill):
    """records: (seq, serial, registration); entities: (id, serial, registration). (seq, entity, is_new, took), and what entities have."""
    serial, owner, has = {}, {}, {}
    for i, s, r in sorted(entities):
        serial.setdefault(s, i) if s else None
        if r and r not in owner:
            owner[r] = has[i] = r and i
            has[i] = r
    out = []
    for k, s, r in sorted(records):
        s, r = s or "", r or ""
        new = took = False
        if not s and not r:
            out.append((k, None, False, False))
            continue
        i = serial.get(s) if s else None
        if i is None:
            i = owner.get(r) if r else None
            if i is None:
                i, new, took = f"new {k}", True, bool(r)
                if s:
                    serial[s] = i
                if r:
                    owner[r], has[i] = i, r
        elif fill and r and owner.get(r, i) == i:
            took = True
            if has.get(i) not in (None, r):
                del owner[has[i]]
            owner[r], has[i] = i, r
        out.append((k, i, new, took))
    return out, {i: r for i, r in has.items() if i in owner.values()}


def resolved(spark, records, entities, fill):
    rows = spark.createDataFrame(records, "seq long, serial string, registration string").repartition(3)
    known = spark.createDataFrame(entities, "entity_id string, serial string, registration string")
    return resolve.get_or_create(rows, known, "seq", fill)


def check(spark, records, entities, fill):
    found = resolved(spark, records, entities, fill)
    got = sorted((r["seq"], r["entity_id"], r["is_new"], r["took"]) for r in found.collect())
    want, has = loop(records, entities, fill)
    names = {i: g for (_, i, *_), (_, g, *_) in zip(want, got, strict=True)}
    assert [(k, names[i], *flags) for k, i, *flags in want] == got
    assert len({g for g in names.values() if g}) == len([i for i in names if i])  # no two entities under one id
    filled = {r["entity_id"]: r["registration"] for r in resolve.entity_rows(found, ["seq"]).collect() if r["registration"]}
    stored = {i: r for i, _, r in entities if r}
    assert all((filled.get(names[i]) or stored.get(i)) == has.get(i) for i in names if i and has.get(i))


KNOWN = [(500, "", "KN1"), (501, "KS1", "KN1"), (502, "KS1", ""), (503, "LS1", "LN1"), (504, "LS1", "LN2"), (505, "LS2", "LN1"), (506, "", "LN2"), (507, "LS3", "LN2")]


@pytest.mark.parametrize("fill", [False, True])
def test_random_chains(spark, fill):
    """Dense and sparse chains side by side, and some known ones."""
    rng = random.Random(3)
    records, entities = list(KNOWN), [("a", "LS1", "LN0")]
    for size, n, to in ((60, 12, "D"), (90, 60, "W")):
        pick = lambda kind, n=n, to=to: rng.choice([None, "", *(f"{to}{kind}{rng.randrange(n)}" for _ in range(6))])
        records += [(k * 2 + (to == "W"), pick("S"), pick("N")) for k in range(size)]
        regs = rng.sample(range(n), 5)
        entities += [(f"e{to}{k}", f"{to}S{rng.randrange(n)}" if k % 3 else None, f"{to}N{regs[k]}" if k % 2 else "") for k in range(5)]
    check(spark, records, entities, fill)


@pytest.mark.parametrize("fill", [False, True])
def test_hot_keys_need_few_rounds(spark, fill, monkeypatch):
    """A serial and a registration that very many records share don't cost a round each."""
    rounds, cut = [], ordered.cut
    monkeypatch.setattr(resolve.ordered, "cut", lambda df: rounds.append(1) or cut(df))
    records = [(k, "HOT", f"N{k}") for k in range(400)] + [(1000 + k, f"S{k}", "NHOT") for k in range(400)] + [(2000, "S5", "N7"), (2001, "HOT", "NHOT")]
    check(spark, records, [], fill)
    assert len(rounds) <= 8


def test_running_over_ranges(spark):
    """What came before a row, in other ranges too; empty keys have nothing."""
    rows = ordered.numbered(spark.range(500).select("id", F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).otherwise("").alias("key")), ["id"])
    out = ordered.running(rows, "key", {"seen": F.when(F.col("id") % 7 == 0, F.col("id"))})
    later = ordered.running(rows, "key", {"next": F.when(F.col("id") % 7 == 0, F.col("id"))}, later=True)
    got = {r["id"]: r["seen"] for r in out.collect()}
    ahead = {r["id"]: r["next"] for r in later.collect()}
    for k in range(500):
        same = [x for x in range(500) if x % 3 == k % 3 and x % 7 == 0] if k % 3 else []
        assert got[k] == max((x for x in same if x < k), default=None) and ahead[k] == min((x for x in same if x > k), default=None)
    assert rows.select(F.shiftright("_k", ordered.PART_BITS)).distinct().count() > 1


def repair_loop(stored, wants):
    """stored: (seq, tail, bad); wants: seq to tail. Outcomes of bad rows, one by one."""
    tail = {k: t for k, t, _ in stored}
    out = []
    for k, _, bad in sorted(stored):
        if not bad:
            continue
        w = wants.get(k)
        if w is None:
            out.append((k, "no_match"))
        elif w == tail[k]:
            out.append((k, "already_right"))
        elif any(t.upper() == w and j != k for j, t in tail.items()):
            out.append((k, "conflict"))
        else:
            tail[k] = w
            out.append((k, "fixed"))
    return out


def repaired(spark, stored, wants):
    """Serials are tails without N, so each names its row's wish in the master."""
    rows = [(k, t, t.replace(" ", "")[1:] if bad else f"X{k}", "c", "d") for k, t, bad in stored]
    master = [(k, wants[k], t.replace(" ", "")[1:], "c") for k, t, bad in stored if bad and k in wants]
    df = spark.createDataFrame(rows, "seq long, n_number string, serial string, code string, date string").repartition(3)
    return repair.applied_tail_repairs(df, spark.createDataFrame(master, "seq long, n_number string, serial string, code string"))


def test_applied_repairs(spark):
    rng = random.Random(1)
    tails = [f"N{k}" for k in rng.sample(range(100, 160), 50)]
    stored = [(k, t, rng.random() < 0.85) for k, t in enumerate(tails)]
    wants = {k: f"N{rng.randrange(100, 164)}" for k in range(50) if rng.random() < 0.95}
    got = sorted((r["seq"], r["outcome"]) for r in repaired(spark, stored, wants).collect())
    want = repair_loop(stored, wants)
    assert got == want and {o for _, o in want} >= {"conflict", "fixed"}
    assert any(o == "fixed" and wants[k] in tails for k, o in want)  # freed tails were claimed


def test_repairs_of_a_long_chain(spark, monkeypatch):
    """Each row takes the tail that the one before it has left: few rounds. Two rows that share a tail must both leave."""
    rounds, cut = [], ordered.cut
    monkeypatch.setattr(repair.ordered, "cut", lambda df: rounds.append(1) or cut(df))
    stored = [(k, f"N{5000 - k}", True) for k in range(300)]
    wants = {k: f"N{5001 - k}" for k in range(300)}
    assert {r["outcome"] for r in repaired(spark, stored, wants).collect()} == {"fixed"}
    assert len(rounds) <= 5 + 10
    twice = [(0, "N1", True), (1, "n1", True), (2, "N3", True), (3, "N4", True)]
    for wants in ({0: "N7", 1: "N8", 2: "N1", 3: "N3"}, {0: "N7", 1: "N7", 2: "N1", 3: "N3"}):
        master = [(k, w, s, "c") for k, w, s in ((0, wants[0], "1"), (2, wants[2], "3"), (3, wants[3], "4"))] + [(9, wants[1], "N1", "c")]
        rows = [(k, t, {0: "1", 1: "N1", 2: "3", 3: "4"}[k], "c", "d") for k, t, _ in twice]
        got = repair.applied_tail_repairs(spark.createDataFrame(rows, "seq long, n_number string, serial string, code string, date string"), spark.createDataFrame(master, "seq long, n_number string, serial string, code string"))
        assert sorted((r["seq"], r["outcome"]) for r in got.collect()) == repair_loop(twice, wants)


@pytest.mark.parametrize("fill", [False, True])
def test_repeated_pairs_need_few_rounds(spark, fill, monkeypatch):
    """Records that repeat an aircraft's serial and registration don't wait for each other, and what is written shrinks
    with the records that are open."""
    sizes, cut = [], ordered.cut
    monkeypatch.setattr(resolve.ordered, "cut", lambda df: [out := cut(df), sizes.append(out.count())][0])
    records = [(k, f"S{k % 10}", f"N{k % 10}") for k in range(600)] + [(600 + k, f"S{k % 10}", f"N{k % 10 + 20}") for k in range(300)]
    check(spark, records, [], fill)
    assert len(sizes) <= 14 and sum(sizes) <= 8 * 900


@pytest.mark.parametrize("fill", [False, True])
@pytest.mark.parametrize("seed", range(2))
def test_small_worlds(spark, fill, seed):
    """Few serials and registrations, so that those change hands again and again."""
    rng = random.Random(seed)
    pick = lambda kind, n: rng.choice(["", *(f"{kind}{rng.randrange(n)}" for _ in range(9))])
    check(spark, [(k, pick("S", 4), pick("N", 6)) for k in range(40)], [("a", "S0", "N1"), ("b", "S1", "N1"), ("c", "", "N2")], fill)
