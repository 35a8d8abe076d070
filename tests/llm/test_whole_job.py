"""Cases in which an operator once did less than the whole job."""

from llm_helpers import as_rows, documents
from refillscope.llm import queries
from refillscope.llm.templates import contaminated


def stored(tmp_path, **tables):
    """Write the tables where the registered queries read them."""
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_op4_finds_a_line_with_one_inner_word_changed(spark, tmp_path):
    line = [f"w{i}" for i in range(20)]
    other = [*line[:10], "new", *line[11:]]
    sf_dir = stored(tmp_path, documents=documents(spark, [(1, " ".join(line)), (2, " ".join(other)), (3, "v1 v2 v3 v4 v5 v6")]))
    found = as_rows(queries.op4_line_dedup(spark, sf_dir), "doc_id", "n_removed")
    assert found == [(1, 0), (2, 1), (3, 0)]


def test_op4_finds_copies_of_short_lines(spark, tmp_path):
    sf_dir = stored(tmp_path, documents=documents(spark, [(1, "Read more\nx"), (2, "y\nread more"), (3, "a b c d e"), (4, "a b c d\nread")]))
    found = as_rows(queries.op4_line_dedup(spark, sf_dir), "doc_id", "removed_lines")
    assert found == [(1, []), (2, [1]), (3, []), (4, [0])]


def leaks(spark, text, *docs):
    """Ids (from 1 on) of the documents that hold the item."""
    found = contaminated(documents(spark, list(enumerate(docs, 1))), spark.createDataFrame([(1, text)], "item_id long, text string"))
    return [r[0] for r in as_rows(found, "doc_id")]


def test_op10_finds_an_item_in_another_letter_case(spark):
    item = "If Mary has 12 apples and gives 5 apples to John while Peter takes what Anna left how many does she have"
    assert leaks(spark, item, f"Some words. {item.upper()}? more", f"x {item.lower()}", "if mary has nothing") == [1, 2]


def test_op10_finds_arithmetic_items_word_for_word(spark):
    item = "Calculate 144 / 12 + 7 * 3 - 50 % 8"
    assert leaks(spark, item, f"Now: {item}. Next", "Calculate 144 / 12 + 7 * 4 - 50 % 8", "Calculate 144 / 12 - 7 * 3 - 50 % 8") == [1]
    assert leaks(spark, "What is 12 + 35 * 4 - 7?", "so what is 12 + 35 * 4 - 7 then", "what is 12 + 35") == [1]


def test_op10_finds_renamed_items(spark):
    item = "Natalia sold 48 clips to her friends in April. Natalia then sold half as many clips in May. How many clips did Natalia sell in all?"
    longer = item.replace("Natalia", "Mary Ann")
    other = "Alice sold 48 clips to no one and then went home in May."
    assert leaks(spark, item, item.replace("Natalia", "Alice"), f"x. {longer}", other) == [1, 2]
