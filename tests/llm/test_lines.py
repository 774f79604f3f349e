"""Line templates on planted lines."""

from broadsheet.llm import line_templates

LONG = "the quick brown fox jumps over the lazy dog every single morning at dawn"


def cleaned(spark, docs):
    rows = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, n_lines int")
    out = line_templates.dedup_lines(rows)
    assert out.columns == rows.columns
    return sorted(((r[0], r[1]) for r in out.collect()), key=repr)


def own(i):
    return f"document {chr(97 + i)} says something {chr(97 + i) * 3} that nobody else {chr(98 + i) * 4} has ever said"


def test_shared_lines_stay_in_the_first_document_only(spark):
    docs = [(i, f"{own(i)}\n{LONG}\nshort one") for i in (3, 1, 2)]
    assert cleaned(spark, docs) == [
        (1, f"{own(1)}\n{LONG}\nshort one"),
        (2, f"{own(2)}\nshort one"),
        (3, f"{own(3)}\nshort one"),
    ]


def test_variable_fields_generalise(spark):
    docs = [(i, f"{own(i)}\nposted on {i} May by the weather desk of the paper in {w}") for i, w in ((1, "Rome"), (2, "Oslo"), (3, "Bern"))]
    assert [t for _, t in cleaned(spark, docs)] == [docs[0][1], own(2), own(3)]


def test_copies_go_and_clean_documents_stay(spark):
    text = "\n".join(own(i) for i in range(6))
    changed = text.replace("nobody", "someone", 1)
    docs = [(1, text), (2, text), (3, changed), (4, own(9)), (5, None), (6, ""), (None, text)]
    assert cleaned(spark, docs) == sorted([(1, text), (4, own(9)), (5, None), (6, ""), (None, text)], key=repr)


def test_repeats_within_one_document_stay(spark):
    docs = [(1, f"{LONG}\n{LONG}"), (1, f"{LONG}\n{LONG}"), (2, own(2))]
    assert cleaned(spark, docs) == docs


def test_order_of_rows_does_not_matter(spark):
    docs = [(i, f"{own(i)}\n{LONG}\n{own(i % 3)}") for i in range(12)]
    assert cleaned(spark, docs) == cleaned(spark, docs[::-1])


def test_empty_and_long(spark):
    assert cleaned(spark, []) == []
    long = "\n".join(f"line {chr(97 + i % 26)}{chr(97 + i // 26)} of a long text" for i in range(600))
    assert cleaned(spark, [(1, long), (2, own(2))]) == [(1, long), (2, own(2))]


def test_a_document_of_shared_lines_keeps_its_own_line(spark):
    shared = [own(i) for i in range(9)]
    docs = [(i, f"{x}\n{own(i + 10)}") for i, x in enumerate(shared)]
    docs += [(20, "\n".join([*shared, "only I say so"])), (21, f"only I say so\n{own(21)}"), (22, "\n".join([*shared, "end"]))]
    assert cleaned(spark, docs) == sorted([*docs[:9], (20, "only I say so"), (21, own(21))], key=repr)


def test_number_tables_are_not_templates(spark):
    tables = [(i, "\n".join(" ".join(str(i * 1000 + 7 * r + c) for c in range(n)) for r in range(4))) for i, n in ((1, 3), (2, 3), (3, 9), (4, 9))]
    assert cleaned(spark, tables) == tables
    labelled = [(i, f"{own(i)}\nOslo {i} 2{i} 3{i} 4{i} 5{i} 6{i} 7{i}") for i in (1, 2)]
    assert cleaned(spark, labelled) == labelled
    row = "1 2 3 4 5 6 7 8 9"
    assert cleaned(spark, [(i, f"{own(i)}\n{row}") for i in (1, 2)]) == [(1, f"{own(1)}\n{row}"), (2, own(2))]
