"""Discovery over stored list pages: unique links, what each page added, and a log.

The crawl itself, with its stop rules, is not data processing; pages come as a table with
`page` (their order) and `html`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from silverline.functions.nodes import with_nodes
from silverline.operators import pages as pg
from silverline.operators.keyed import first_seen, keep_first
from silverline.operators.quality import discovery_log
from silverline.sources.shared import fresh_path


class Discovered(Mapping):
    """Tables by name, each built when it is first asked for; all of them read the pages' stored rows."""

    def __init__(self, **builders: Callable[[], DataFrame]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _discover(pages: DataFrame, rows: Column, url: str, partitions: int | None) -> Discovered:
    """`links`: each url once, from the first place that shows it; `progress`: found, new and
    known per page; `log`: records found and error per page.

    Pages are parsed once and their rows stored in the shared folder.
    """
    spark, path = pages.sparkSession, fresh_path(pages.sparkSession, "discovered")
    with_nodes(pages.select("page", "html"), partitions=partitions).select(
        "page", F.col("nodes").isNull().alias("failed"), rows.alias("rows")).write.parquet(path)
    parsed = spark.read.parquet(path)
    found = (parsed.select("page", F.posexplode("rows").alias("at", "row"))
             .select("page", "at", "row.*").filter(F.col(url).isNotNull()))
    error = F.when(F.col("failed"), "ParseError")
    return Discovered(
        links=lambda: keep_first(found, [url], ["page", "at"]).drop("at"),
        progress=lambda: first_seen(found, url, "page"),
        log=lambda: discovery_log(parsed, "page", F.coalesce(F.size("rows"), F.lit(0)), error))


def discover_products(pages: DataFrame, base: str, partitions: int | None = None) -> Discovered:
    return _discover(pages, pg.listing_cards(F.col("nodes"), base), "product_url", partitions)


def discover_ingredients(pages: DataFrame, base: str, prefix: str,
                         partitions: int | None = None) -> Discovered:
    return _discover(pages, pg.dictionary_rows(F.col("nodes"), base, prefix), "ingredient_url", partitions)
