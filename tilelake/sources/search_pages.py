"""``spark.read.format("stac_pages")``: recorded searches, one task per chunk and collection.

Layout: ``<path>/<chunk>/<collection>/<page>.json``, or ``.json.gz`` where pages are compressed. The first page by name starts a search;
each page may link to the next (``rel: next``, ``href`` relative to the folder). Links are
followed inside one task, since a page is only known from the one before it.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterable, Iterator

from pyarrow import fs as arrow_fs
from pyarrow.dataset import dataset
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
)

from tilelake.sources.envelopes import parse_features

# Page size limits of the service.
DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE = 1000, 10_000
_SCHEMA = "chunk_id string, collection string, page int, pos int, feature string"


def filesystem(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return arrow_fs.FileSystem.from_uri(path)
    return arrow_fs.LocalFileSystem(), path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark would read it by, so that tasks look in the same place."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


class SearchPartition(InputPartition):
    def __init__(self, chunk: str, collection: str) -> None:
        self.chunk, self.collection = chunk, collection


class SearchReader(DataSourceReader):
    def __init__(
        self, path: str, collections: list[str], page_size: int, chunks: set[str] | None = None
    ) -> None:
        self.path, self.collections, self.page_size = path, collections, page_size
        self.chunk, self.listed = chunks, chunks or set()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equality on chunk and collection decides which searches run at all."""
        for f in filters:
            values = None
            if isinstance(f, EqualTo):
                values = {f.value}
            elif isinstance(f, In):
                values = set(f.value)
            if values is not None and f.attribute == ("collection",):
                self.collections = [c for c in self.collections if c in values]
            elif values is not None and f.attribute == ("chunk_id",):
                self.chunk = values if self.chunk is None else self.chunk & values
            else:
                yield f

    def partitions(self) -> list[SearchPartition]:
        files, root = filesystem(self.path)
        chunks = [
            posixpath.basename(info.path)
            for info in files.get_file_info(arrow_fs.FileSelector(root))
            if info.type == arrow_fs.FileType.Directory
        ]
        if missing := (self.listed & (self.chunk or set())) - {None, *chunks}:
            raise FileNotFoundError(f"{self.path}: no search recorded for chunks {sorted(missing)[:5]}")
        return [
            SearchPartition(chunk, collection)
            for chunk in sorted(chunks) if self.chunk is None or chunk in self.chunk
            for collection in self.collections
        ]

    def read(self, partition: SearchPartition) -> Iterator[tuple]:
        files, root = filesystem(self.path)
        folder = posixpath.join(root, partition.chunk, partition.collection)
        listed = files.get_file_info(arrow_fs.FileSelector(folder))
        names = sorted(i.path for i in listed if i.path.endswith((".json", ".json.gz")))
        if not names:
            raise FileNotFoundError(f"{folder}: no page of this search")
        current, page, seen = names[0], 0, set()
        while current is not None:
            if current in seen:
                raise ValueError(f"{current}: its link comes round again after {page} pages")
            seen.add(current)
            with files.open_input_stream(current) as stream:
                body = json.loads(stream.read())
            features = body.get("features") or []
            if len(features) > self.page_size:
                raise ValueError(f"{current}: {len(features)} features on a page of {self.page_size}")
            for pos, feature in enumerate(features):
                yield partition.chunk, partition.collection, page, pos, json.dumps(feature)
            links = [link for link in body.get("links") or [] if link.get("rel") == "next"]
            current = posixpath.join(folder, links[0]["href"]) if links else None
            page += 1
        if lost := set(names) - seen:
            raise ValueError(f"{folder}: no link leads to {sorted(map(posixpath.basename, lost))[:5]}")


class SearchPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "stac_pages"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> SearchReader:
        collections = [c for c in self.options.get("collections", "").split(",") if c]
        if not collections:
            raise ValueError("at least one collection is required")
        page_size = int(self.options.get("page_size", DEFAULT_PAGE_SIZE))
        if not 1 <= page_size <= MAX_PAGE_SIZE:
            raise ValueError(f"page_size must be between 1 and {MAX_PAGE_SIZE} (got {page_size})")
        chunks = None
        if self.options.get("chunk_table"):
            files, path = filesystem(self.options["chunk_table"])
            listed = dataset(path, filesystem=files, exclude_invalid_files=True)
            chunks = set(listed.to_table(columns=["chunk_id"])["chunk_id"].to_pylist())
        return SearchReader(self.options["path"], collections, page_size, chunks)


def register_source(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SearchPages)


def read_search(
    spark: SparkSession, path: str, collections: list[str], page_size: int = DEFAULT_PAGE_SIZE,
    chunk_table: str | None = None,
) -> DataFrame:
    """Raw search rows; turn them into items with ``items_of``. ``chunk_table`` (Parquet with
    ``chunk_id``) limits the chunks that are searched."""
    register_source(spark)
    path, chunk_table = qualified(spark, path), chunk_table and qualified(spark, chunk_table)
    options = {"path": path, "collections": ",".join(collections), "page_size": str(page_size)}
    if chunk_table:
        options["chunk_table"] = chunk_table
    return spark.read.format("stac_pages").options(**options).load()


def items_of(rows: DataFrame) -> DataFrame:
    return parse_features(rows.drop("collection"))
