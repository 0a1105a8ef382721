"""Data source ``cborseq``: files of CBOR objects one after the other, as rows (url, seq, json)."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.types import StructType

from ..functions import cbor
from .openers import open_url
from .tarshards import Shard, list_shards


def _plain(x: object) -> object:
    return base64.b64encode(x).decode("ascii") if isinstance(x, bytes) else str(x)


class CborReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def partitions(self) -> list[Shard]:
        return [Shard(u) for u in list_shards(self.options["path"])]

    def read(self, partition: Shard) -> Iterator[tuple]:
        with open_url(partition.url) as stream:
            for seq, x in enumerate(cbor.load_all(stream)):
                yield partition.url, seq, json.dumps(x, default=_plain, ensure_ascii=False)


class CborSequence(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cborseq"

    def schema(self) -> str:
        return "url string, seq int, json string"

    def reader(self, schema: StructType) -> CborReader:
        return CborReader(self.options)


def read_cbor(spark: SparkSession, path: str) -> DataFrame:
    """Bytes come as base64 text inside the JSON."""
    spark.dataSource.register(CborSequence)
    return spark.read.format("cborseq").load(path)
