"""Incremental intake of crawled pages."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from leadsieve import constants as C
from leadsieve.functions.html import parse_html
from leadsieve.operators.gate import build_digest, quality_gate
from leadsieve.operators.sites import PAGE_FIELDS, list_sites
from leadsieve.session import stored
from leadsieve.sources.logs import path_exists
from leadsieve.sources.pages import ORDER, page_keys
from leadsieve.sources.store import SiteStore

PAGES_SCHEMA = "page_id bigint, url string, html string"
PLACES = "depth int, no_id boolean, place_id bigint, url string, version bigint, mark string, page string"
_PAGE = "struct<url:string,title:string,description:string,headings:array<string>,text:string,http_status:int>"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstPages(StatefulProcessor):
    """The first pages of each domain, whatever the order in which they land.

    The state of a domain is a list of five places at most with their parsed pages, so it never grows. A page that is
    crawled again replaces its older version; the other pages keep their places.
    """

    def __init__(self, pages: int, keep_ms: int | None):
        self.pages, self.keep_ms = pages, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.places = handle.getListState("places", PLACES, self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd
        names = [f.split()[0] for f in PLACES.split(", ")]
        held: dict[tuple, tuple] = {}

        def take(row: tuple) -> None:
            place, known = row[:4], held.get(row[:4])
            # The order that decides between crawls of one page: latest version, then smallest MD5 of the HTML.
            if known is None or (-row[4], row[5]) < (-known[4], known[5]):
                held[place] = row
            if len(held) > self.pages:
                del held[max(held)]

        before = [tuple(r) for r in self.places.get()] if self.places.exists() else []
        for row in before:
            take(row)
        for frame in rows:
            for row in frame[names].itertuples(index=False, name=None):
                take((int(row[0]), bool(row[1]), int(row[2]), row[3], int(row[4]), *row[5:]))
        after = [held[place] for place in sorted(held)]
        if after != before:
            self.places.put(after)
            yield pd.DataFrame([(key[0], *row) for row in after], columns=["domain", *names])

    def close(self) -> None:
        pass


def incremental_pages(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: str = PAGES_SCHEMA,
                      keep_ms: int | None = None) -> None:
    """Parse and gate the pages that landed since the last run, then stop.

    The stream keeps each domain's first pages as keyed state, so no earlier batch is read again; what a batch
    changes is stored under its domains in a `SiteStore`, whose other buckets are left as they are. A batch that is
    replayed stores the same rows again, and a re-run without new files does nothing. `keep_ms` forgets
    the state of pages that were not crawled again for so long; their stored sites stay until then new pages come. A new
    checkpoint folder would start with empty state, so it is refused where sites are stored already.
    """
    if path_exists(spark, f"{out_dir}/manifest") and not path_exists(spark, checkpoint):
        raise ValueError(f"{out_dir} holds sites, but the checkpoint folder {checkpoint} is new")
    provider = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        landed = parse_html(page_keys(spark.readStream.schema(schema).parquet(in_dir)).withColumn("mark", F.md5("html")))
        places = landed.select("domain", *ORDER, "version", "mark", F.to_json(F.struct(*PAGE_FIELDS), {"ignoreNullFields": "false"}).alias("page"))
        first = places.groupBy("domain").transformWithStateInPandas(
            FirstPages(C.MAX_PAGES, keep_ms), f"domain string, {PLACES}", "Update", "None" if keep_ms is None else "ProcessingTime")
        query = first.writeStream.outputMode("update").foreachBatch(lambda df, batch: _keep(df, batch, out_dir)) \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.unset(_PROVIDER) if provider is None else spark.conf.set(_PROVIDER, provider)


def _keep(changed: DataFrame, batch_id: int, out_dir: str) -> None:
    """Store the sites whose first pages a batch changed."""
    pages = changed.select("domain", *ORDER, F.from_json("page", _PAGE).alias("_page")).select(
        "domain", *ORDER[:-1], F.col("url").alias("place_url"), "_page.*")
    sites = list_sites(pages, *ORDER[:-1], "place_url")
    done = build_digest(quality_gate(sites)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    SiteStore(changed.sparkSession, out_dir).upsert(stored(done, "landed-sites"), "batch_id")


def current_sites(spark: SparkSession, out_dir: str) -> DataFrame:
    """One record per domain: that of its latest batch."""
    return SiteStore(spark, out_dir).read()
