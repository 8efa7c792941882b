"""Mixing of sources: targets by exact fractions, takes by plain loops, positions by integration."""

import re
from collections import defaultdict
from fractions import Fraction
from hashlib import md5

import pytest

from sparkq.llm import mixture
from sparkq.llm.mixture import mix, targets, training_order

SCHEMA = "doc_id long, text string, source string, target string, size int"


def fill(sizes, weights, share=Fraction(3, 2), most=2):
    """Targets by resharing the excess, in exact fractions."""
    capped, total = set(), share * sum(sizes)
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        got = [most * s if i in capped else left * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in capped and got[i] > most * s}
        if not over:
            return got
        capped |= over


def brute(rows, schedules=mixture.SCHEDULES):
    """doc_id, size, source_size, target, taken of each (doc_id, text, source)."""
    of = defaultdict(list)
    for doc_id, text, source in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        told = f"{'-' if doc_id is None else doc_id}:{text or ''}"
        of[source].append((md5(told.encode()).hexdigest(), size, doc_id))
    names = sorted(of, key=lambda s: (s is None, (s or "").encode()))
    weights = [Fraction(sum(s), len(s)) for s in (schedules[i % len(schedules)] for i in range(len(names)))]
    sizes = [sum(size for _, size, _ in of[s]) for s in names]
    out = []
    for name, whole, target in zip(names, sizes, fill(sizes, weights)):
        goal = int(target + Fraction(1, 2))
        stream = sorted(of[name], key=lambda r: r[:2])
        taken = [0] * len(stream)
        for _ in range(2):
            for i, (_, size, _) in enumerate(stream):
                some = min(goal, size)
                taken[i] += some
                goal -= some
        assert goal == 0
        out += [(d, size, whole, float(target), n) for (_, size, d), n in zip(stream, taken)]
    return sorted(out, key=repr)


def rows_of(n):
    text = lambda i: " ".join(["w"] * (i * 7 % 23)) + f" {i}\t\n\x0b"
    sources = ["b", "a", None, "ä", "b", "b", "b", "Z", "b\U0001f99c", "b￮"]
    rows = [(i, text(i), sources[i % len(sources)]) for i in range(n)]
    return rows + [(None, None, "a"), (None, "", None), (1, "same text", "b"), (1, "same text", "b"), (1, "other", "b"), (n, None, "empty")]


@pytest.mark.parametrize("cell_rows", [7, 100_000])
def test_takes_equal_plain_loops(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(mixture, "CELLS", 2)
    monkeypatch.setattr(mixture, "CELL_ROWS", cell_rows)
    rows = rows_of(300)
    docs = spark.createDataFrame([(*r, "clash", -1) for r in rows], SCHEMA).repartition(5)
    mixed = mix(docs)
    got = sorted(map(tuple, mixed.select("doc_id", "size", "source_size", "target", "taken").collect()), key=repr)
    want = brute(rows)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert all(abs(g[3] - w[3]) <= 1e-9 * w[3] for g, w in zip(got, want))
    assert all(n <= 2 * size for _, size, _, _, n in got)


def test_positions_follow_the_schedules(spark):
    """Up to any time a source has given its share of the schedule's integral."""
    docs = spark.createDataFrame([(i, "one two three", "abc"[i % 3]) for i in range(3000)], "doc_id long, text string, source string")
    mixed = mix(docs)
    order = training_order(mixed).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    target = {r.source: r.target for r in mixed.select("source", "target").distinct().collect()}
    assert sum(r.words for r in order) == pytest.approx(sum(target.values()), abs=3)
    for source, schedule in zip("abc", mixture.SCHEDULES):
        for time in (0.1, 1 / 3, 0.5, 2 / 3, 0.9):
            whole, rest = divmod(time * 3, 1)
            due = (sum(schedule[: int(whole)]) + rest * schedule[int(whole)]) / sum(schedule) * target[source]
            given = sum(r.words for r in order if r.source == source and r.position < time)
            assert abs(given - due) <= 4
    placed = [r.position for r in mixed.select("position").collect()]
    assert placed == sorted(placed, key=lambda p: (p is None, p))


def test_targets_reshare_until_none_is_above(spark):
    sizes = [1, 10, 5, 10_000, 0, 3, 500]
    weights = [5.0, 2.0, 1.0, 5.0, 2.0, 1.0, 5.0]
    rows = spark.createDataFrame(list(zip(range(7), sizes, weights)), "i int, source_size long, weight double")
    got = [r.target for r in targets(rows, 1.5, 2).orderBy("i").collect()]
    assert got == pytest.approx([float(x) for x in fill(sizes, [Fraction(w) for w in weights])])


def test_odd_tables_and_reruns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix(empty).count() == 0
    wordless = spark.createDataFrame([(1, None, None, None, None), (2, " \t", "s", None, 1)], SCHEMA)
    assert [(r.size, r.target, r.taken, r.position, r.uses) for r in mix(wordless).collect()] == [(0, 0.0, 0, None, [])] * 2
    docs = spark.createDataFrame([(*r, None, 0) for r in rows_of(60)], SCHEMA)
    first, again = (sorted(map(repr, mix(docs.repartition(n)).collect())) for n in (2, 7))
    assert first == again
    with pytest.raises(ValueError):
        mix(docs, schedules=((1, 2), (3,)))


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(*r, None, 0) for r in rows_of(9)], SCHEMA)
    plan = mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
