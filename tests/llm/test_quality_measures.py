"""Quality measures: repeated windows at a text's ends, blank lines, and what the plan costs."""

from tidemark.llm import quality_votes


def test_windows_and_lines_are_measured_once(spark):
    texts = [None, "", "a b c d", "a b c d e", "a b c d e f a b c d e", "a b c d e a b c d", "x\n \t\x0b\n\n x\nx\r\n\x0c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    measured = quality_votes.measure(docs)
    got = {r["row"]["doc_id"]: r["measures"] for r in measured.collect()}
    assert [got[n]["n_repeat_words"] for n in range(7)] == [0, 0, 0, 0, 10, 0, 0]
    assert [got[n]["n_lines"] for n in range(7)] == [0, 0, 1, 1, 1, 1, 3]
    # One pattern for each of symbols, capitals, letters and exclamation marks; lines need none.
    assert measured._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 4
