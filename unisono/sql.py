"""The engine from SQL: views, functions by name, and a table function.

`python -m unisono.sql TABLES "select ..."` prints the rows of a query over the tables of a folder.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from unisono.functions import offsets
from unisono.functions.text import STOPWORDS, TEMPLATE, TOKEN
from unisono.sources import tables

#: Functions that SQL can say itself stay in the JVM.
_PLAIN = {
    "content_words(ngram string) returns int": "size(filter(split(ngram, ' '), t -> not array_contains(array({words}), t)))",
    "is_low_content(ngram string) returns boolean": "size(filter(split(ngram, ' '), t -> not array_contains(array({words}), t))) < 2",
    "is_template(ngram string) returns boolean": "ngram rlike {template}",
}


class PhraseOccurrences:
    """A row for each run of tokens of a text that is the phrase: start and end in characters, and the tokens around it."""

    def eval(self, text: str, phrase: str, around: int):
        toks = list(re.finditer(TOKEN, offsets.lower_in_place(text or "")))
        words = [m.group() for m in toks]
        want = (phrase or "").split()
        for i in range(len(words) - len(want) + 1):
            if want and words[i : i + len(want)] == want:
                yield toks[i].start(), toks[i + len(want) - 1].end(), " ".join(words[max(0, i - around) : i]), " ".join(words[i + len(want) : i + len(want) + around])


def register_functions(spark: SparkSession) -> None:
    """Functions by name, and the table function."""
    text = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    for head, body in _PLAIN.items():
        spark.sql(f"create or replace temporary function {head} return " + body.format(words=", ".join(map(text, STOPWORDS)), template=text(TEMPLATE)))
    spark.udf.register("sentence_spans", F.pandas_udf(lambda s: s.map(lambda t: [{"start": a, "end": b} for a, b in offsets.whole_sentences(t)]), offsets.SPANS))
    spark.udtf.register("phrase_occurrences", F.udtf(PhraseOccurrences, returnType="start int, end int, before string, after string"))


def register(spark: SparkSession, folder: str) -> None:
    """Views of every Parquet table of `folder` and of `statements`; functions content_words, is_low_content, is_template and
    sentence_spans; the table function phrase_occurrences(text, phrase, around)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    for f in hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop):
        name = f.getPath().getName()
        if name.endswith(".parquet"):
            spark.read.parquet(f"{folder}/{name}").createOrReplaceTempView(name.removesuffix(".parquet"))
    if spark.catalog.tableExists("documents"):
        tables.statements(spark, folder).createOrReplaceTempView("statements")
    register_functions(spark)


def main(args: list[str]) -> None:
    from unisono.session import session

    folder, text = args
    spark = session(**{"spark.ui.showConsoleProgress": "false"})
    register(spark, folder)
    spark.sql(text).show(1000, truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
