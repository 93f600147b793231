"""Token counts as delta-maintained rollups by source, language and tokenizer version.

A batch is a set of signed changes: an insert adds a document and its tokens, a delete takes away what was counted,
a revised count takes away the old number and adds the new one. A commit sums the batch by key, before and after the
shuffle, adds the sums to the running totals of the last version, and writes new totals with the list of batches that
they hold. Then a small file that names this table is renamed to the next version number, which one writer only can do:
that is the commit. A writer that lost the race adds its sums to the winner's totals and tries again; a batch that the
totals hold is left alone, one that broke off has left no trace that anything reads, so a repeated commit changes
nothing. Reading the totals reads one small table, however many batches there were. Tables of older versions than the
last ``KEEP`` are deleted. Keys that came back to nothing are left out.

Defined results: null source, language or version are keys of their own; null and empty texts count zero tokens and
one document; very long texts are counted whole; repeated rows count each; an empty batch commits and changes nothing;
null counts are zeros. A batch may come before the one it corrects, so totals may be below zero in between. Extra columns
are not read; a kept column may not be called like a result (an error).
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import forget, saved
from larder.llm.packing import PRETOKEN

KEYS = ("source", "lang", "tokenizer_version")
CHANGE = "source string, lang string, tokenizer_version string, docs bigint, tokens bigint"
KEEP = 3


def count_tokens(docs: DataFrame, vocabularies: dict[str, str], text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """source, lang, the kept columns, tokenizer_version, tokens: a row for each document and rank file (by version)."""
    taken = {"source", "lang", "tokenizer_version", "tokens", "_text"} & {k.lower() for k in keep}
    if taken:
        raise ValueError(f"kept columns are called like results: {sorted(taken)}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        counters = {}
        for version, path in vocabularies.items():
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            counters[version] = tiktoken.Encoding(version, pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for batch in batches:
            texts = batch.pop("_text")
            for version, encode in counters.items():
                yield batch.assign(tokenizer_version=version, tokens=np.array([len(encode(t)) if t else 0 for t in texts], np.int64))

    source = docs.select(docs["source"].cast("string").alias("source"), docs["lang"].cast("string").alias("lang"), *keep, docs[text].cast("string").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInPandas(run, f"{kinds}, tokenizer_version string, tokens bigint")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("bigint").alias("docs"), F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("bigint").alias("docs"), (-F.coalesce("tokens", F.lit(0))).cast("bigint").alias("tokens"))


def revisions(counts: DataFrame, old: str = "tokens", new: str = "new_tokens") -> DataFrame:
    return counts.select(*KEYS, F.lit(0).cast("bigint").alias("docs"), (F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0))).cast("bigint").alias("tokens"))


class Rollup:
    """Running totals in a folder that all machines share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _version(self) -> tuple[int, str | None]:
        """The number of the last version, 0 before the first, and its table."""
        files = self._files()
        if not files.exists(self._path("versions")):
            return 0, None
        numbers = [int(f.getPath().getName()) for f in files.listStatus(self._path("versions")) if f.getPath().getName().isdigit()]
        if not numbers:
            return 0, None
        stream = files.open(self._path(f"versions/{max(numbers)}"))
        try:
            return max(numbers), stream.readUTF()
        finally:
            stream.close()

    def _publish(self, number: int, table: str) -> bool:
        """Make a table the version of this number; false if there is one."""
        jvm, files = self.spark._jvm, self._files()
        files.mkdirs(self._path("versions"))
        claim = self._path(f"versions/claim-{uuid.uuid4().hex}")
        stream = files.create(claim, False)
        stream.writeUTF(table)
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        how = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # never over a file
        try:
            context.rename(claim, self._path(f"versions/{number}"), how)
        except Py4JJavaError as e:
            files.delete(claim, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def _read(self, table: str | None, part: str, schema: str) -> DataFrame:
        if table is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{table}/{part}")

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        return sorted(r["batch"] for r in self._read(self._version()[1], "batches", "batch string").collect())

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; false if it was committed before."""
        if not batch or not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a batch is named by letters, digits, - and _")
        if self._holds(batch):
            return False
        sums = saved(_sums(changes))
        try:
            while not self._holds(batch):
                number, table = self._version()
                new = f"table-{uuid.uuid4().hex}"
                _sums(self._read(table, "totals", CHANGE).unionByName(sums)).where("docs <> 0 or tokens <> 0").write.parquet(f"{self.folder}/{new}/totals")
                name = self.spark.range(1).select(F.lit(batch).alias("batch"))
                self._read(table, "batches", "batch string").unionByName(name).coalesce(1).write.parquet(f"{self.folder}/{new}/batches")
                if self._publish(number + 1, new):
                    self._tidy(number + 1)
                    return True
                self._files().delete(self._path(new), True)
            return False
        finally:
            forget(sums)

    def _holds(self, batch: str) -> bool:
        return not self._read(self._version()[1], "batches", "batch string").where(F.col("batch") == batch).isEmpty()

    def _tidy(self, number: int) -> None:
        """Delete the version that is no longer kept, and its table."""
        files, old = self._files(), self._path(f"versions/{number - KEEP}")
        if files.exists(old):
            stream = files.open(old)
            table = stream.readUTF()
            stream.close()
            files.delete(self._path(table), True)
            files.delete(old, False)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, docs, tokens."""
        return self._read(self._version()[1], "totals", CHANGE)


def _sums(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
