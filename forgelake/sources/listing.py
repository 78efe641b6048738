"""A data source of captured listing pages: files named {repo_key}__{state}__{page}.html in a folder.

    spark.dataSource.register(ListingSource)
    spark.read.format("listing").option("path", folder).option("pages", 25).load()

One partition per `pages` files; pages are read where they are needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


@dataclass
class Pages(InputPartition):
    files: list[str]


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.pages = options["path"], int(options.get("pages", 25))

    def partitions(self) -> list[Pages]:
        files = sorted(str(p) for p in Path(self.folder).glob("*__*__*.html"))
        return [Pages(files[i:i + self.pages]) for i in range(0, len(files), self.pages)] or [Pages([])]

    def read(self, partition: Pages) -> Iterator[tuple]:
        for f in partition.files:
            repo, state, page = Path(f).stem.rsplit("__", 2)
            yield repo, state, int(page) if page.isdigit() else None, Path(f).read_text(encoding="utf-8", errors="replace")


class ListingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return "repo_key string, pr_state string, page_no int, html string"

    def reader(self, schema) -> ListingReader:
        return ListingReader(dict(self.options))
