import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `set` string, token long, `key` int, _row string, label string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def family(seed, n, words, edits):
    """n copies of one text with so many words changed in each."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def frame(spark, rows):
    """Documents with columns whose names operators use themselves; rows are (doc_id, text, source)."""
    full = [(i, t, "en", s, len(t or ""), "s", 1, 2, "r", "l") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def edge_rows():
    """Nulls in any column, empty and long texts, ties and repeated rows."""
    long = " ".join(f"long{i % 977} {i}" for i in range(20_000))
    return [
        (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one", "b"), (5, "one", "b"), (5, "one", "b"), (6, "One  two", None), (7, "one two", "b"),
        (None, "one two", "c"), (None, None, None), (8, long, "hot"), (9, long, "hot"), (10, "é ü ß 漢字 🙂 é", "b"), (11, "word " * 3000, "hot"),
    ]


def component_ids(ids, linked):
    """The smallest id that links reach, by plain search."""
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            for x in (a, b):
                if label[x] != low:
                    label[x], changed = low, True
    return label
