"""Small tables with every awkward row, and plain-Python versions of the operators' definitions."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root long, node long, cell long, rep long, payload string"


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices(["an", "the", "or", "ing", "en", "é", "ß", "on"], k=rnd.randint(1, 4))) for _ in range(n))


def awkward():
    """(doc_id, text): copies, near copies, ties, repeated rows, nulls, empties, one very long text."""
    base = prose(1, 120).split()
    near = base.copy()
    near[60] = "changed"
    rows = [(i, prose(100 + i, 5 + 7 * i)) for i in range(12)]
    rows += [(20, " ".join(base)), (21, " ".join(near)), (22, " ".join(base).upper()), (23, " ".join(base))]
    rows += [(24, " ".join(base[:60]) + "\n" + prose(77, 60)), (30, None), (31, ""), (32, " \n\t "), (33, "one"), (34, "One"), (35, "two words")]
    rows += [(40, "same " * 400), (41, "same " * 90), (42, prose(5, 30) + "\n" + prose(5, 30) + "\n" + prose(6, 30))]
    rows += [(50, prose(9, 6000)), (51, "x" * 3000 + " " + prose(9, 40)), (60, "tail 😀 中文 \x00 end"), (None, " ".join(base)), (None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, None if i % 3 else "en", "s", None, 1, 2, 3, 4, "p") for i, (d, t) in enumerate(rows)], SCHEMA)


def shingle_set(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[j : j + width]) for j in range(max(1, len(w) - width + 1))) if w else frozenset()


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}
