"""Operator 3, token counts: totals by source, language and tokenizer version, kept by signed batches.

A batch holds signed rows: an insert counts +1 document and +tokens, a delete
-1 and -tokens, a revision -old and +new. A commit sums a batch in its tasks and
writes the sums (a few rows) as one folder under the batch's id; the folder
counts once its success mark is there, so an id that was committed is not
counted again, and one that broke off is written anew. Totals are the sums over
committed folders; ``compact`` folds them into one, which keeps the ids.

Defined cases: null texts have no tokens but count as documents; null sources,
languages and tokenizer versions are groups of their own; keys whose counts came back to zero leave
the totals; repeated rows count as often as they come; an empty batch is a valid
commit; only named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.llm.common import remove, ship, words_of, written
from fleetfeatures.llm.tokens import BytePairCounter, once, tokenizer_file

KEYS = ["source", "lang", "tokenizer"]
#: ``batch_id`` is set in the id marks of a fold only; folders of batches, and older ones, have no such column.
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch_id string"


def tokens_of(file: str) -> Callable[[Column], Column]:
    """A column function: the number of tokens of a text, with the rank file given."""
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            counter = once(BytePairCounter, file)
            yield texts.map(lambda t: len(counter.ids(t)))

    counted = F.pandas_udf(count, "long")
    return lambda text: counted(F.coalesce(text, F.lit("")))


def inserts(counts: DataFrame) -> DataFrame:
    return _signed(counts, 1, "tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return _signed(counts, -1, "tokens")


def revisions(counts: DataFrame, old: str, new: str) -> DataFrame:
    """Signed rows that replace the count in column ``old`` by that in ``new``."""
    return _signed(counts, -1, old).unionAll(_signed(counts, 1, new))


def _signed(counts: DataFrame, sign: int, tokens: str) -> DataFrame:
    return counts.select(*KEYS, F.lit(sign).cast("long").alias("n_docs"), (F.col(tokens) * sign).alias("n_tokens"))


def _folder_of(batch_id: str) -> str:
    """The folder of a batch: one name, whatever separators its id holds."""
    return f"batch-{quote(batch_id, safe='')}"


def _id_of(folder: str) -> str:
    return unquote(folder.removeprefix("batch-"))


class Rollup:
    """Totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._file = jvm.org.apache.hadoop.fs.Path
        self._fs = self._file(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _folders(self) -> list[str]:
        """Committed folders; after a compaction that broke off, only what is not folded yet beside the newest fold."""
        if not self._fs.exists(self._file(self.path)):
            return []
        names = sorted(x.getPath().getName() for x in self._fs.listStatus(self._file(self.path)))
        done = [n for n in names if self._fs.exists(self._file(f"{self.path}/{n}/_SUCCESS"))]
        folds = [n for n in done if n.startswith("fold-")]
        if not folds:
            return done
        inside = self._ids_of(folds[-1])
        return [folds[-1], *(n for n in done if not n.startswith("fold-") and _id_of(n) not in inside)]

    def _ids_of(self, fold: str) -> set[str]:
        rows = self.spark.read.schema(TOTALS).parquet(f"{self.path}/{fold}").filter(F.col("batch_id").isNotNull())
        return {r.batch_id for r in rows.select("batch_id").collect()}

    def committed(self) -> set[str]:
        ids: set[str] = set()
        for name in self._folders():
            ids |= self._ids_of(name) if name.startswith("fold-") else {_id_of(name)}
        return ids

    def commit(self, batch_id: str, signed: DataFrame) -> bool:
        """Add a batch; False if its id is there already (then nothing changes)."""
        if batch_id in self.committed():
            return False
        self._sums(signed).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{_folder_of(batch_id)}")
        return True

    @staticmethod
    def _sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def _rows(self) -> DataFrame:
        folders = [f"{self.path}/{n}" for n in self._folders()]
        read = self.spark.read.schema(TOTALS)
        return read.parquet(*folders) if folders else self.spark.createDataFrame([], TOTALS)

    def totals(self) -> DataFrame:
        rows = self._rows().filter(F.col("batch_id").isNull())
        return self._sums(rows).filter("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> None:
        """Fold all batches into one folder, with their ids; then delete what was folded."""
        old, ids = self._folders(), sorted(self.committed())
        marks = self.spark.createDataFrame([(None, None, None, 0, 0, i) for i in ids], TOTALS)
        number = 1 + max([int(n.removeprefix("fold-")) for n in old if n.startswith("fold-")], default=0)
        self.totals().unionByName(marks, allowMissingColumns=True).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/fold-{number:09d}")
        for name in old:
            remove(self.spark, f"{self.path}/{name}")


def maintained_counts(docs: DataFrame, path: str, batches: int = 4,
                      file: str = "byte_bpe_50k.tiktoken", version: str = "byte_bpe_50k-1") -> DataFrame:
    """Totals of a table that arrives in batches: words are counted on arrival and revised to tokens later,
    one batch is withdrawn and comes back."""
    spark = docs.sparkSession
    ship(spark)
    tokens = tokens_of(tokenizer_file(file))
    # one pass over the texts, for the provisional counts and the final ones
    counts = written(docs.select("source", "lang", F.lit(version).alias("tokenizer"),
                                 F.size(words_of(F.col("text"))).cast("long").alias("words"),
                                 tokens(F.col("text")).alias("tokens"),
                                 F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch")))
    rollup = Rollup(spark, path)
    for k in range(batches):
        rollup.commit(f"arrival-{k}", _signed(counts.filter(F.col("batch") == k), 1, "words"))
    rollup.commit("tokens", revisions(counts, "words", "tokens"))
    rollup.commit("arrival-0", _signed(counts.filter("batch = 0"), 1, "words"))  # sent again: no effect
    taken = counts.filter("batch = 1")
    rollup.commit("withdrawn-1", deletes(taken))
    rollup.commit("returned-1", inserts(taken))
    rollup.compact()
    return rollup.totals()
