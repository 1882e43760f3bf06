"""A transactional sink for tables behind any DB-API driver: all rows of a batch replace the old ones, or none does.

Tasks put their rows into a staging table of the write, marked with their attempt. The commit on the driver runs one
transaction: the batch's old rows go, the rows of the attempts that were committed come in. A failed task or an aborted
write leaves the table as it was, and a rerun of a batch leaves the same table.
"""

from __future__ import annotations

import importlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

FORMAT = "transactional_table"
BATCH = 1000
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


@dataclass
class Staged(WriterCommitMessage):
    attempt: str
    rows: int


class TableWriter(DataSourceWriter):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.driver, self.table = options["driver"], options["table"]
        self.connect = json.loads(options.get("connect", "{}"))
        self.replace, self.batch = json.loads(options["replace"]), int(options.get("batchsize", BATCH))
        self.columns = schema.fieldNames()
        wrong = [n for n in (self.table, *self.columns, *self.replace) if not _NAME.fullmatch(n)]
        if wrong or not self.replace or set(self.replace) - set(self.columns):
            raise ValueError(f"not a name, or not a column: {wrong or sorted(set(self.replace) - set(self.columns)) or 'replace is empty'}")
        self.stage = f"{self.table}_stage_{uuid.uuid4().hex}"

    def _open(self):
        module = importlib.import_module(self.driver)
        return module.connect(**self.connect), "?" if module.paramstyle == "qmark" else "%s"

    def _create(self, cursor) -> None:
        kept = ", ".join(f"{c}" for c in self.columns)
        cursor.execute(f"CREATE TABLE IF NOT EXISTS {self.stage} AS SELECT {kept}, '{'0' * 32}' AS attempt_ FROM {self.table} WHERE 1 = 0")

    def write(self, iterator: Iterator[Row]) -> Staged:
        attempt, n, held = uuid.uuid4().hex, 0, []
        at = [self.columns.index(c) for c in self.replace]
        connection, mark = self._open()
        try:
            cursor = connection.cursor()
            self._create(cursor)
            insert = f"INSERT INTO {self.stage} VALUES ({', '.join([mark] * (len(self.columns) + 1))})"
            for row in iterator:
                if [str(row[i]) for i in at] != [str(v) for v in self.replace.values()]:
                    raise ValueError(f"a row of another batch than {self.replace}")
                held.append((*row, attempt))
                n += 1
                if len(held) == self.batch:
                    cursor.executemany(insert, held)
                    held = []
            if held:
                cursor.executemany(insert, held)
            connection.commit()
        finally:
            connection.close()
        return Staged(attempt, n)

    def commit(self, messages: list[Staged | None]) -> None:
        attempts = [m.attempt for m in messages if m is not None]
        connection, mark = self._open()
        try:
            cursor, columns = connection.cursor(), ", ".join(self.columns)
            self._create(cursor)
            connection.commit()
            old = " AND ".join(f"{c} = {mark}" for c in self.replace)
            cursor.execute(f"DELETE FROM {self.table} WHERE {old}", tuple(self.replace.values()))
            for a in range(0, len(attempts), self.batch):
                some = attempts[a : a + self.batch]
                cursor.execute(f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM {self.stage} WHERE attempt_ IN ({', '.join([mark] * len(some))})", tuple(some))
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()
        self._drop()

    def abort(self, messages: list[Staged | None]) -> None:
        self._drop()

    def _drop(self) -> None:
        connection, _ = self._open()
        try:
            connection.cursor().execute(f"DROP TABLE IF EXISTS {self.stage}")
            connection.commit()
        finally:
            connection.close()


class TransactionalTable(DataSource):
    """``df.write.format("transactional_table")`` with the options driver, connect, table, replace and batchsize."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> TableWriter:
        return TableWriter(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TransactionalTable)


def replace_batch(rows: DataFrame, table: str, replace: dict[str, str], driver: str, connect: dict, batch: int = BATCH) -> None:
    """Puts ``rows`` in the place of the rows of ``table`` that have the values of ``replace`` (column: value), all or nothing.

    ``driver`` is a DB-API module that driver and executors can import, ``connect`` its keyword arguments. Rows with other
    values of those columns are an error; without rows the old ones go. The table exists and has the rows' columns.
    """
    register(rows.sparkSession)
    options = {"driver": driver, "connect": json.dumps(connect), "table": table, "replace": json.dumps(replace), "batchsize": str(batch)}
    rows.write.format(FORMAT).options(**options).mode("append").save()
