"""Loops that a restarted driver takes up where the last one ended."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from kinweave.session import write_and_read


class Rounds:
    """The state of an iterative job in a lasting folder that all executors reach.

    A finished round is a folder of its tables and a manifest. The manifest is written last, under another name, and then
    renamed, so a round counts as a whole or not at all; what a broken round left behind is written anew. Two rounds are kept,
    since the plan of a round may still read the one before it. ``job`` says what is computed of what; a folder of another job
    is refused. One driver at a time may use a folder.
    """

    def __init__(self, spark: SparkSession, path: str, job: str):
        self._spark, self._path, self._job = spark, path.rstrip("/"), job
        self._fs = self._hadoop("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._manifest = None
        for status in self._fs.listStatus(self._hadoop("")) if self._fs.exists(self._hadoop("")) else ():
            name = status.getPath().getName()
            if name.startswith("manifest-") and name.endswith(".json"):
                found = json.loads(self._read(name))
                if found["job"] != job:
                    raise ValueError(f"{path} holds the rounds of another job: {found['job']}")
                if self._manifest is None or found["round"] > self._manifest["round"]:
                    self._manifest = found

    @property
    def done(self) -> int:
        """Finished rounds."""
        return self._manifest["round"] if self._manifest else 0

    @property
    def step(self) -> int:
        """The step that the last finished round ended with."""
        return self._manifest["step"] if self._manifest else 0

    def tables(self) -> dict[str, DataFrame]:
        """The tables of the last finished round."""
        schemas = self._manifest["tables"] if self._manifest else {}
        read = lambda name, schema: self._spark.read.schema(StructType.fromJson(schema)).parquet(self._folder(self.done, name))
        return {name: read(name, schema) for name, schema in schemas.items()}

    def finish(self, step: int = 0, **tables: DataFrame) -> dict[str, DataFrame]:
        """Write the tables of the next round, then its manifest, and return their scans."""
        this = self.done + 1
        written = {name: write_and_read(df, self._folder(this, name)) for name, df in tables.items()}
        manifest = {"job": self._job, "round": this, "step": step, "tables": {n: df.schema.jsonValue() for n, df in tables.items()}}
        self._write(f"manifest-{this:06d}.json", json.dumps(manifest))
        self._manifest = manifest
        if this > 2:
            for old in (f"manifest-{this - 2:06d}.json", f"round-{this - 2:06d}"):
                self._fs.delete(self._hadoop(old), True)
        return written

    def clear(self) -> None:
        """Delete the folder; nothing may read its tables any more."""
        self._fs.delete(self._hadoop(""), True)
        self._manifest = None

    def _hadoop(self, name: str):
        return self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{name}" if name else self._path)

    def _folder(self, number: int, name: str) -> str:
        return f"{self._path}/round-{number:06d}/{name}"

    def _read(self, name: str) -> str:
        stream = self._fs.open(self._hadoop(name))
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write(self, name: str, text: str) -> None:
        draft = self._hadoop(f"_{name}.draft")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._fs.rename(draft, self._hadoop(name)):
            raise RuntimeError(f"could not write {self._path}/{name}")
