"""Small documents with every awkward case, and plain Python versions of the operators."""

import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, line string, key string, n_words int"


def prose(seed, n_words=80, lines=4):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 8))) for _ in range(n_words)]
    size = max(1, n_words // lines)
    return "\n".join(" ".join(words[i:i + size]) + "." for i in range(0, n_words, size))


def awkward_texts():
    base = prose(1)
    words = base.split(" ")
    near = " ".join([*words[:40], "changed", *words[41:]])
    return [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \t\n "), (7, "ab cd"), (8, "ab cd"),
        (9, prose(2, 3000, 40)), (10, "x" * 30_000), (11, "  two  spaces \n\n end "), (12, "💥 ünï 中文 \x1c\x85 x"),
        (None, base), (None, "no id here, none at all, as it were"), (14, prose(3)), (14, prose(3)), (15, "." * 50),
        (16, "\n".join(["A line that is long enough to be compared."] * 3)),
        (17, "A line that is long enough to be compared!\nshort"),
    ]


def frame(spark, rows):
    """Rows (doc_id, text) with extra columns, some named like the operators' own."""
    full = [(i, t, "en" if t else None, None, None, "clash", "clash", 1) for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def lower_ascii(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def shingle_sets(rows, size=4):
    found = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
        n = max(1, len(words) - size + 1)
        found[doc_id] = {tuple(words[i:i + size]) for i in range(n)} if words else set()
    return found


def near_components(sets):
    """Smallest id reachable over links of similarity 0.8 or more, by comparing all pairs."""
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def within_one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1:] or (len(a) == len(b) and a[i + 1:] == b[i + 1:])
