"""Line dedup splits a text once for its hashes and once for its result, however many lines it has."""

from __future__ import annotations

import re

import llm.brute as brute
import pytest
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES
from tidemark.llm.line_dedup import LineRuns, line_key


def test_texts_are_read_once_for_hashes(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        reads.add(1)
        return text

    docs = brute.documents(spark, [f"line that is everywhere\nline of number {i}" for i in range(20)])
    got = LineRuns(spark, buckets=2).dedup(docs.withColumn("text", counted.asNondeterministic()("text")))
    assert sum(r["n_dropped"] for r in got.collect()) == 19
    assert reads.value == 2 * 20


def test_kept_lines_are_not_split_anew_for_each(spark):
    text = "\n".join(f"line number {i}" for i in range(3000))
    docs = brute.documents(spark, ["line number 7", text + "\nline number 7"])
    got = LineRuns(spark, buckets=2).dedup(docs).where("doc_id = 1")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"\[lambda ", plan) and not re.search(r"-1\)\[lambda ", plan)
    kept = [line for line in text.split("\n") if line != "line number 7"]
    assert [(r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got.collect()] == [(3001, 2, "\n".join(kept))]


@pytest.mark.parametrize("inner", ["Ab cD", "ÀÉ àé İI ıK K Σς ǅ Ⅷ", "a b ", "\U0001f600Z", ""])
def test_key_of_any_ends(spark, inner):
    ends = ["", *SPACES, "\t \r", " ", " ", "\x1f"]
    lines = [a + inner + b for a in ends for b in ends]
    got = spark.createDataFrame([(line,) for line in lines], "line string").select("line", line_key(F.col("line")).alias("key"))
    assert {r["line"]: r["key"] for r in got.collect()} == {line: brute.lower(line.strip(SPACES)) for line in lines}
