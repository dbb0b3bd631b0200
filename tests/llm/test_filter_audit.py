"""The filter audit against a walk of every order over every document, and the path counts of the lattice."""

import collections
import itertools
import math
import re

from vardelta.llm import filter_audit

PROSE = " ".join(f"word{k}" for k in range(60))
ROWS = [
    # doc_id, text, source, extra columns with clashing names
    (1, PROSE, "a", "x", 1),
    (2, PROSE, "a", "x", 1),
    (2, PROSE, "b", "x", 1),
    (None, PROSE, "a", None, None),
    (3, "few words", "a", "x", 1),
    (4, "few words", None, "x", 1),
    (5, "same " * 80, "b", "x", 1),
    (6, "LOUD # " * 70, "b", "x", 1),
    (7, None, "a", "x", 1),
    (8, "", "b", "x", 1),
    (9, " \n\t", None, "x", 1),
    (10, ("Ünï漢 " + PROSE + " ") * 3000, "a", "x", 1),
    (11, PROSE.upper(), "hot", "x", 1),
    *[(k, "copy of " + PROSE, "hot", "x", 1) for k in range(20, 90)],
]
LABELS = [(1, 1, 0, "p"), (1, 0, 1, "p"), (3, 1, 0, "p"), (5, 0, 1, "p"), (30, 1, 1, "p"), (None, 1, 1, "p"), (6, None, None, "p"), (77, 1, 0, "p")]
DOC_TYPE = "doc_id long, text string, source string, part string, n long"
LABEL_TYPE = "doc_id long, quality int, toxic int, part string"


def failing(rows):
    least = collections.defaultdict(list)
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""].append(doc_id)
    for doc_id, text, source, *_ in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        out = "A" if len(words) < 50 else ""
        out += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        out += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
        out += "D" if re.search(r"[#$%&*|]", text) else ""
        out += "E" if doc_id is not None and doc_id > min(least[text]) else ""
        yield doc_id, source or "", set(out)


def walked(rows, labels):
    good = {d for d, q, t, *_ in labels if q == 1 and d is not None}
    toxic = {d for d, q, t, *_ in labels if t == 1 and d is not None}
    parts = collections.defaultdict(list)
    for doc_id, part, fails in failing(rows):
        parts[part].append((doc_id, fails))
    out = {}
    for part, docs in parts.items():
        total = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                removed = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                total[f] += len(removed)
                failed = sum(f in x[1] for x in docs)
                out[part, "".join(order), step] = [
                    len(left), len(removed), failed - len(removed), sum(x[1] == {f} for x in docs),
                    sum(x[0] in good for x in removed), sum(x[0] in toxic for x in removed),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def test_audit_equals_walk_of_every_order(spark):
    docs = spark.createDataFrame(ROWS, DOC_TYPE).repartition(3)
    labels = spark.createDataFrame(LABELS, LABEL_TYPE)
    got = filter_audit.audit(filter_audit.failed(docs, labels), "ABCDE").collect()
    want = walked(ROWS, LABELS)
    assert len(got) == 600 * 4
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in got} == want


def test_shapley_shares_add_up_to_what_all_filters_remove(spark):
    docs, labels = spark.createDataFrame(ROWS, DOC_TYPE), spark.createDataFrame(LABELS, LABEL_TYPE)
    rows = filter_audit.audit(filter_audit.failed(docs, labels), "ABCDE").where("filter_order = 'ABCDE'").collect()
    for part in {r.part for r in rows}:
        own = [r for r in rows if r.part == part]
        assert sum(r.shapley for r in own) == math.factorial(5) * sum(r.removed for r in own)


def test_path_counts():
    for k in (1, 2, 5):
        reaching, leaving = filter_audit.path_counts(k)
        for s in range(1 << k):
            assert reaching[s] == math.factorial(s.bit_count()) and leaving[s] == math.factorial(k - s.bit_count())
        assert all(sum(w for _, f, w in filter_audit.edges(k) if f == g) == math.factorial(k) for g in range(k))


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOC_TYPE), spark.createDataFrame([], LABEL_TYPE)
    assert filter_audit.audit(filter_audit.failed(docs, labels), "ABCDE").count() == 0
    some = filter_audit.failed(spark.createDataFrame(ROWS[:3], DOC_TYPE), labels)
    assert {r.toxic_lost for r in filter_audit.audit(some, "ABCDE").collect()} == {0}
