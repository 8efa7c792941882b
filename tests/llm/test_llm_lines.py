"""Units, repeated units and cleaned texts."""

from pyspark.sql import functions as F

from sparkq.llm.lines import MIN_WORDS, cut, normalise, remove_repeated, repeated_units

PASSAGE = (
    "Seven brave sailors left the harbour at dawn. Nobody had told them about the storm. "
    "Ah. Their small boat carried bread, water and one old map of the coast."
)


def test_units_are_the_whole_text():
    text = "First line here.\nA long enough sentence of words. Short one. Another long sentence that has words.\n\nx"
    spans = list(cut(text))
    assert "".join(text[a:b] for a, b in spans) == text
    assert [text[a:b] for a, b in spans][1] == "A long enough sentence of words. Short one. "
    assert list(cut("")) == []
    assert normalise("  The Same\tUNIT. ") == normalise("the same unit")


def plain(rows):
    seen, out = {}, set()
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        for a, b in cut(text or ""):
            unit = normalise(text[a:b])
            if unit.count(b" ") + 1 >= MIN_WORDS and seen.setdefault(unit, (i, a)) != (i, a):
                out.add((i, a, b))
    return out


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_passage_inside_lines(spark):
    rows = [
        (1, f"Some words before it. {PASSAGE} And what follows is different there."),
        (2, f"Other words stand here without a stop {PASSAGE} what follows has other words again."),
        (3, "A clean document of its own that shares nothing. Of the. Of the."),
        (4, None),
        (5, ""),
        (None, PASSAGE),
        (6, "The. " * 30_000),
    ]
    docs = documents(spark, rows).withColumn("removed", F.lit(1)).withColumn("start", F.lit(2))
    got = {(r.doc_id, r.start, r.end) for r in repeated_units(docs).collect()}
    assert got == plain(rows)
    assert {i for i, *_ in got} == {1, 2}  # the document without id ranks first
    clean = {r.doc_id: r.text for r in remove_repeated(docs).collect()}
    assert len(clean) == len(rows)
    assert "small boat" not in clean[1] + clean[2] and clean[None] == PASSAGE
    assert clean[3] == rows[2][1] and clean[4] is None and clean[5] == "" and clean[6] == rows[6][1]


def test_original_offsets_are_retained(spark):
    rows = [(1, PASSAGE), (2, "Before it are these five words.\n" + PASSAGE + "\nAfter.")]
    done = {r.doc_id: r for r in remove_repeated(documents(spark, rows)).collect()}
    text, gone = rows[1][1], done[2].removed
    kept, at = "", 0
    for span in gone:
        kept += text[at : span.start]
        at = span.end
    assert kept + text[at:] == done[2].text and done[1].removed is None
    again = documents(spark, [(i, r.text) for i, r in done.items()])
    assert repeated_units(again).count() == 0


def test_repeated_rows_and_ties(spark):
    line = "the same five words here"
    rows = [(1, f"{line}\n{line}"), (1, f"{line}\n{line}"), (1, f"other text before that line\n{line}")]
    docs = documents(spark, rows)
    clean = sorted(r.text for r in remove_repeated(docs).collect())
    assert len(clean) == 3 and sum(c.count(line) for c in clean) in (1, 2)
    assert clean.count(clean[0]) + clean.count(clean[-1]) >= 2
    assert remove_repeated(docs.limit(0)).count() == 0


def test_hot_passage_in_most_documents(spark):
    rows = [(i, f"a line all of them share here\nown words number {i} of this document") for i in range(3000)]
    got = repeated_units(documents(spark, rows))
    assert got.count() == 2999 and got.where("first_doc_id <> 0").isEmpty()


def test_names_and_ids_of_the_caller(spark):
    """Columns of any name pass unchanged; ids keep their type."""
    rows = [(i, f"line of number {i} is its own\n{PASSAGE}") for i in ("b", "a", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    names = ["removed", "spans", "__spans", "__id", "__of", "__key", "id", "of", "key", "row"]
    clashing = docs.select("*", *[F.lit(n).alias(n) for n in names])
    clean = remove_repeated(clashing, removed=None)
    assert clean.columns == clashing.columns
    by_id = {r.doc_id: r for r in clean.collect()}
    assert all(r[n] == n for r in by_id.values() for n in names)
    assert PASSAGE in by_id[None].text and "small boat" not in by_id["a"].text + by_id["b"].text
    found = repeated_units(docs).collect()
    assert {(r.doc_id, r.first_doc_id) for r in found} == {("a", None), ("b", None)}
    spans = remove_repeated(clashing).where("doc_id = 'a'").first()
    assert [tuple(s) for s in spans.removed] == [(r.start, r.end) for r in sorted(found, key=lambda r: r.start) if r.doc_id == "a"]
