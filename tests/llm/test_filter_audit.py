"""Orders of filters against a document-by-document replay."""

from itertools import permutations

import numpy as np

from leafmill.llm import filter_audit

DOCS = "doc_id bigint, text string, source string, failed int, part string"
GOOD = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    None, "", "short", GOOD, GOOD + " $", GOOD.upper(), "same " * 70, "Same# " * 10, GOOD + " " + "x" * 30_000,
    " \t\n".join(GOOD.split()), "é " * 49 + "z", "word\x0b" * 30 + " ".join(f"v{i}" for i in range(30)),
]


def fails(rows):
    """Per document the letters it fails, read from the definition."""
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        bad = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == text for o in rows),
        }
        out.append({k for k, v in bad.items() if v})
    return out


def replay(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    failing = fails(rows)
    out = {}
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, failing, strict=True) if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(letter in f for _, f in own) - len(gone), sum(f == {letter} for _, f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def audited(spark, rows, labels):
    documents = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS).repartition(3)
    judged = spark.createDataFrame([(*x, "text") for x in labels], "doc_id bigint, quality int, toxic int, text string")
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = filter_audit.audit_filters(documents, judged).collect()
    return {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in found}


def test_every_order_equals_a_replay(spark):
    rng = np.random.default_rng(3)
    sources = ["a", "b", None, ""]
    rows = [(int(i), TEXTS[rng.integers(len(TEXTS))], sources[rng.integers(4)]) for i in rng.permutation(90)]
    rows += [(None, GOOD, "a"), (None, None, None), (7, GOOD, "b"), (7, GOOD, "b"), (200, GOOD + " own", "only")]
    labels = [(int(i), int(rng.integers(2)), int(rng.integers(2))) for i in range(0, 95, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None)]
    got = audited(spark, rows, labels)
    assert got == replay(rows, labels)
    assert len(got) == 120 * 5 * 4  # a, b, only, and null and empty sources as one


def test_empty_tables(spark):
    assert audited(spark, [], []) == {}
    assert audited(spark, [(1, GOOD, "a")], [])["a", "ABCDE", 5] == [1, 0, 0, 0, 0, 0, 0]


def test_min_plus_steps():
    masks = np.array([[True, False, True], [False, False, False], [True, True, True]])
    positions = np.array([[0, 1, 2], [2, 0, 1], [1, 2, 0]])
    assert filter_audit.removal_steps(masks, positions).tolist() == [[0, 1, 0], [3, 3, 3], [0, 0, 0]]
