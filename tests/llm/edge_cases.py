"""Small tables with awkward rows: nulls in every column, empty and long texts, ties, repeated rows, clashing names."""

import random

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long, score double, size long, component string",
    "embeddings": "vec_id long, embedding array<float>, label int, rank int, score double",
    "conversations": "conv_id long, turn long, role string, text string, formatted string",
}


def sentence(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def thue_morse(letters, size):
    """The first letters of the Thue-Morse word: it and its complement defeat polynomial hashes mod 2**64."""
    return "".join(letters[k.bit_count() % 2] for k in range(size))


def documents():
    rng = random.Random(5)
    en, fr = [f"{a}{b}" for a in "the of and er ing".split() for b in "th sh ou wh ed".split()], [f"{a}{b}" for a in "le la é eau que".split() for b in "ment ré oi ç ai".split()]
    rows = []

    def add(text, lang="en", source="a", doc_id=-1):
        rows.append((len(rows) if doc_id == -1 else doc_id, text, lang, source, None if text is None else len(text), 1.0, 2, "x"))

    for k in range(40):
        add(sentence(rng, rng.randint(1, 60), en), "en", "hot" if k % 3 else "b")
    for _ in range(30):
        add(sentence(rng, rng.randint(3, 60), fr), "fr", rng.choice(["a", None, "é"]))
    base = sentence(rng, 120, en)
    for k in range(12):  # near copies of one text, and an exact one in other case
        parts = base.split()
        parts[k * 9] = f"new{k}"
        add(" ".join(parts))
    add(base)
    add(base.upper())
    for text in (None, "", "  \n\t ", "one", "one two three", "one two three", "12345 !!! 678", "É", "a" * 5000, "<|endoftext|> x <|startoftext|>", "a   b \n\n c  ", "x y\x1cz\x0b"):
        add(text, None, None)
    add("the secret: abcdef123 and password = 'hunter22' " + "0123456789abcdef" * 2 + " token=abc secret=token:abcdef AKIA" + "Z" * 20)
    add("ghp_" + "a1" * 20 + " 😀 api_key=😀 apikey:\"Zz09+/_.=-\" secret=short AKIAAKIA" + "0" * 12)
    add(sentence(rng, 20_000, en), "en", "hot")
    for size in (1024, 4096):
        add(thue_morse("yz", size) + " same end", "fr", "b")
        add(thue_morse("zy", size) + " same end", "fr", "b")
    add("null id", "en", "a", None)
    add("null id", "en", "a", None)
    add("twice the same row", "en", "a", 7)
    add("twice the same row", "en", "a", 7)
    return rows


def embeddings():
    rng = random.Random(6)
    rows = [(k, [rng.gauss(0, 1) for _ in range(8)], 0, 1, 1.0) for k in range(0, 300)]
    rows += [(1000 + k, [0.5] * 8, 0, 1, 1.0) for k in range(120)]  # ties: one common vector
    rows += [(2000, None, 0, 1, 1.0), (2050, [None] * 8, 0, 1, 1.0), (2100, [float("nan")] * 8, 0, 1, 1.0), (2150, [float("inf")] + [0.0] * 7, 0, 1, 1.0), (2200, [0.0] * 8, 0, 1, 1.0)]
    rows += [(None, [1.0] * 8, 0, 1, 1.0), (2300, [1.0] * 3, 0, 1, 1.0), (50, rows[50][1], 0, 1, 1.0), (50, rows[51][1], 0, 1, 1.0), (7, rows[8][1], 0, 1, 1.0)]
    rows += [(2400, [2.0, -1.0, 0.5], 0, 1, 1.0), (2401, [1.0, 1.0, 1.0], 0, 1, 1.0), (2500, [3.0], 0, 1, 1.0)]
    return rows


def conversations():
    rows = [(1, 1, "assistant", "yes", "f"), (1, 0, "user", "hi <|im_end|> <\\| <| <\\\\|", "f"), (2, 0, None, None, None), (2, None, "user", "x", None), (None, 0, "user", "q", None)]
    rows += [(3, 0, "a|b\n%7C", "\n", None), (4, 0, "user", "é😀", None), (4, 1, "assistant", "", None), (4, 1, "assistant", "", None)]
    rows += [(6, 0, "user", "q", None), (6, 1, "assistant", "very long <| " * 30_000, None)]
    return rows + [(5, k, "assistant" if k % 2 else "user", f"t{k}", None) for k in range(500)]
