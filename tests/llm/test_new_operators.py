"""Line dedup, filter audit and vector codes on small inputs, against brute force."""

import hashlib
import random
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest

from paytrail.llm import filter_audit, line_dedup, resident_lloyd

WHITE = " \t\n\v\f\r"
DOCS = "doc_id long, text string, lang string, row string, id int, salt int, n_lines string, pos int"


def frame(spark, rows):
    """Documents with columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, lang, "r", 7, 8, "x", 9) for i, t, lang in rows], DOCS)


# ---- 11 line dedup ----

def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def deduped(rows, min_chars, min_docs):
    def who(i, t):
        return (0, 0, t or "") if i is None else (1, i, "")

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = lower(line.strip(WHITE))
            if len(key) >= min_chars:
                holders[key].add(who(i, t))
    out = []
    for i, t in rows:
        kept = [line for line in (t or "").split("\n") if len(holders.get(k := lower(line.strip(WHITE)), ())) < min_docs
                or max(holders[k]) == who(i, t)]
        out.append((i, "\n".join(kept), (t or "").count("\n") + 1, (t or "").count("\n") + 1 - len(kept)))
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    lines = ["", " ", "short", "Ä" * 6, "ÄBC defg", "\tABC DEFG ", "abc defg\v", "common line number one", "COMMON line number ONE\r",
             "x" * 300, "only here and there", " abc defg", "éclair au chocolat", "tail\\n", "$1 \\2 line of it"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(7))) for _ in range(60)]
    rows = [(rng.choice([*range(25), None]), rng.choice([*texts, None, ""])) for _ in range(150)]
    rows += rows[:10] + [(1000 + i, "common line number one\nand its own line %d" % i) for i in range(40)]
    for min_chars, min_docs in [(5, 3), (8, 5), (1, 1)]:
        got = line_dedup.dedupe(frame(spark, [(i, t, "en") for i, t in rows]), min_chars=min_chars, min_docs=min_docs)
        assert got.columns == ["doc_id", "text", "lang", "row", "id", "salt", "pos", "n_lines", "n_dropped"]
        want = deduped(rows, min_chars, min_docs)
        # Null ids: the largest text is the brute force's last document, the operator's goes by a hash.
        known = [tuple(r) for r in got.where("doc_id is not null").select("doc_id", "text", "n_lines", "n_dropped").collect()]
        if min_chars > 1:
            assert sorted(known) == sorted(w for w in want if w[0] is not None)
        assert got.count() == len(rows)


def test_line_dedup_null_ids_and_empty_table(spark):
    line = "a line that many documents without any id do hold"
    rows = [(None, f"{line}\n{i}", "en") for i in range(9)] + [(None, None, None)]
    got = line_dedup.dedupe(frame(spark, rows)).collect()
    assert sorted(r.n_dropped for r in got) == [0, 0] + [1] * 8
    kept_by_id = line_dedup.dedupe(frame(spark, [*rows, (1, line, "en")])).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in kept_by_id) == [(0, 0)] + [(0, 1)] * 9 + [(1, 0)]
    assert line_dedup.dedupe(frame(spark, rows).where("false")).count() == 0


def test_line_dedup_of_a_very_long_text(spark):
    line = "the same line of forty and more characters, over and over"
    long = "\n".join(f"{line} {i % 100_000}" for i in range(200_000))
    rows = [(i, long, "en") for i in range(5)] + [(9, line, "en")]
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.dedupe(frame(spark, rows)).collect()}
    assert got == {**{i: (200_000, 200_000) for i in range(4)}, 4: (200_000, 0), 9: (1, 0)}


# ---- 12 filter audit ----

def fails(rows):
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    out = []
    for i, t, lang in rows:
        t = t or ""
        words = t.translate(str.maketrans(WHITE, " " * 6)).split(" ")
        words = [w for w in words if w]
        f = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
             "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t),
             "E": i is not None and smallest[t] < i}
        out.append((i, lang or "", {k for k, v in f.items() if v}))
    return out


def audited(rows, labels):
    good, toxic = {}, {}
    for i, q, x in labels:
        if i is not None:
            good[i] = max(good.get(i, 0), int(q == 1))
            toxic[i] = max(toxic.get(i, 0), int(x == 1))
    docs, out = fails(rows), {}
    for part in {p for _, p, _ in docs}:
        mine, shapley = [(i, f) for i, p, f in docs if p == part], defaultdict(int)
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, f in enumerate(order):
                gone = [i for i, bad in left if f in bad]
                left = [(i, bad) for i, bad in left if f not in bad]
                all_fail = sum(f in bad for _, bad in mine)
                shapley[f] += len(gone)
                out[part, "".join(order), step + 1] = [
                    len(left), len(gone), all_fail - len(gone), sum(bad == {f} for _, bad in mine),
                    sum(good.get(i, 0) for i in gone), sum(toxic.get(i, 0) for i in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_filter_audit_equals_brute_force(spark):
    rng = random.Random(5)

    def text():
        kind = rng.randrange(6)
        if kind == 0:
            return rng.choice([None, "", "one # two", "SHOUT", "same text"])
        n = rng.choice([20, 199, 200, 260])
        words = [f"w{rng.randrange(n // 2 if kind == 1 else 5000)}" for _ in range(n)]
        if kind == 2:
            words[rng.randrange(n)] = "$%"
        if kind == 3:
            words = [w.upper() for w in words]
        return rng.choice([" ", "\n", " \v\t"]).join(words) + rng.choice(["", " ", "é"])

    pool = [text() for _ in range(60)]
    rows = [(rng.choice([*range(70), None]), rng.choice(pool), rng.choice(["en", "de", "", None])) for _ in range(160)]
    rows += rows[:5]
    labels = [(rng.choice([*range(70), None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(frame(spark, rows), marks).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == audited(rows, labels)
    assert len(got) == 3 * 600
    assert filter_audit.audit(frame(spark, rows).where("false"), marks).count() == 0
    none = filter_audit.audit(frame(spark, rows[:20]), marks.where("false")).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in none} == audited(rows[:20], [])


# ---- 13 vector codes ----

def lloyd(rows, entries=16, rounds=6):
    kept = [(i, lab, np.floor(4096.0 * np.array(v, np.float64)).astype(np.int64)) for i, v, lab in rows
            if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))
    x = np.array([v for _, _, v in kept]).reshape(len(kept), 8, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assign():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        code, _ = assign()
        for p in range(8):
            for e in range(books.shape[1]):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    books[p, e] = [int(s) // len(mine) for s in mine.sum(0)]
    code, error = assign()
    sums = defaultdict(int)
    for (_, lab, _), e in zip(kept, error.sum(1)):
        sums[lab] += int(e)
    h = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in cs), int(e), sums[lab], h)
                   for (i, lab, _), cs, e in zip(kept, code, error.sum(1))), key=str)


VECTORS = "vec_id long, embedding array<float>, label int, part int, entry string, n int, salt int, ints int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, "e", 2, 3, 4) for i, v, lab in rows], VECTORS)


def test_resident_lloyd_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(12, 32))
    rows = [(int(i), (middle[rng.integers(12)] + rng.normal(size=32) * 0.4).astype(np.float32).tolist(), int(rng.integers(4)))
            for i in rng.permutation(300)]
    rows += [(400 + i, rows[0][1], None) for i in range(200)]  # a common vector
    rows += [rows[1]] * 3 + [(None, rows[2][1], None), (None, rows[5][1], 2)]
    rows += [(500, None, 1), (501, [], 1), (502, [None] + [0.0] * 31, 1), (503, [float("nan")] * 32, 1), (504, [float("inf")] + [0.5] * 31, 1)]
    got = resident_lloyd.compress(vectors(spark, rows).repartition(7))
    assert sorted((tuple(r) for r in got.collect()), key=str) == lloyd(rows)


def test_resident_lloyd_few_rows_lengths_and_empty_table(spark):
    rows = [(3, [0.5] * 8, 1), (5, [-0.5] * 8, 1), (9, [0.25] * 8, None)]
    got = resident_lloyd.compress(vectors(spark, [*rows, (1, [1.0] * 7, 1), (7, [1.0] * 16, 1), (8, [1e30] * 8, 1)]))
    assert sorted((tuple(r) for r in got.collect()), key=str) == lloyd(rows)
    empty = resident_lloyd.compress(vectors(spark, rows[:0]))
    assert empty.count() == 0 and empty.columns == got.columns


def test_resident_lloyd_only_members_that_change_are_shuffled(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist(), 0) for i in range(200)]
    kept = resident_lloyd.same_length(resident_lloyd.integers(vectors(spark, rows)))
    seeds = np.array([r.ints for r in kept.orderBy("vec_id").limit(4).collect()]).reshape(4, 8, 2).transpose(1, 0, 2)
    first = kept.select("ints").mapInArrow(resident_lloyd._first_members(seeds), resident_lloyd._MEMBERS)
    books = resident_lloyd._updated(first, seeds)
    moved = first.mapInArrow(resident_lloyd._reassigned(books, True), resident_lloyd._MEMBERS).collect()
    stay = first.mapInArrow(resident_lloyd._reassigned(books, False), resident_lloyd._MEMBERS).collect()
    assert moved and stay and sum(r.n for r in moved) + sum(r.n for r in stay) == 200 * 8
    for r in moved + stay:
        assert r.entry == resident_lloyd.nearest(np.array([r.part]), books[r.pos])[0][0]


@pytest.mark.parametrize("value, floor", [(-0.0001, -1), (0.0, 0), (-1.0, -4096), (0.99999, 4095)])
def test_integers_go_down(spark, value, floor):
    got = resident_lloyd.integers(vectors(spark, [(1, [value] * 8, 1)])).select("ints").head()[0]
    assert got == [floor] * 8
