"""Fixity of WARC replicas by Merkle trees.

Pages become WARC response records; files hold records in order, so a record has an offset range in its file. A leaf is the digest
of a record and its range; a node is the digest of its children in order and of the range that they span. Files have trees, whose
roots are leaves of one tree over the archive. Two replicas whose roots agree are equal; else the audit descends, level by level,
only into nodes that differ, until it names records: corrupt (other bytes), moved (same bytes at another offset), missing or extra.

`write_warc` and `read_warc` put records into files and read them back with their offsets.

Defined cases: null url or html count as empty; a null page_id, or one that is no whole number, is
ordered by its digest in files of its own; ids keep their type; very long pages stand whole in their record; repeated page_ids are
told apart by their order of digests; an empty table gives an empty audit; other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

#: Ids that share a file, and children of a node.
IDS_PER_FILE, FANOUT = 256, 16


def record_of(url: Column, html: Column) -> Column:
    """Text of a WARC record."""
    body = F.coalesce(html.cast("string"), F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"))
    return F.concat(head, F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


TAIL = "\r\n\r\n"


def _number(page_id: str = "page_id") -> Column:
    """The id as a number; null for ids that are none, which are filed by digest."""
    return F.expr(f"try_cast(`{page_id}` AS BIGINT)")


def write_warc(pages: DataFrame, path: str, least: int = 0) -> None:
    """Pages as WARC files under path, one folder a file number, records in the order of `records`. The end of a record is the writer's line end."""
    body = record_of(F.col("url"), F.col("html"))
    own = pages.select(_file_of(_number(), F.sha2(body, 256), least, 1 << 40).alias("file"), "page_id", body.alias("body"), F.sha2(body, 256).alias("sha"))
    rows = own.repartition("file").sortWithinPartitions("file", "page_id", "sha")
    rows.select("file", F.expr(f"substring(body, 1, length(body) - {len(TAIL)})").alias("value")).write.partitionBy("file").option("lineSep", TAIL).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, start, length, sha, url, body) of the records of WARC files under path, each by its Content-Length; gzip files are unpacked. Header names are read in any case; what isn't a record, or has no length, is passed over up to the next one; a record that is cut off ends its file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, raw in zip(batch["file"], batch["content"], strict=True):
                raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else bytes(raw)
                rows, at = [], 0
                while (head := raw.find(b"\r\n\r\n", at)) >= 0:
                    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in raw[at:head].split(b"\r\n")[1:])}
                    length = fields.get(b"content-length", b"")
                    if not raw.startswith(b"WARC/", at) or not length.isdigit():  # no record: go on at the next one
                        at = raw.find(b"WARC/", at + 1)
                        if at < 0:
                            break
                        continue
                    end = head + 4 + int(length) + len(TAIL)
                    if end > len(raw):
                        break
                    rows.append((file, len(rows), at, end - at, hashlib.sha256(raw[at:end]).hexdigest(), fields.get(b"warc-target-uri", b"").decode(errors="replace"), raw[head + 4 : end - len(TAIL)]))
                    at = end
                yield pd.DataFrame(rows, columns=["file", "ordinal", "start", "length", "sha", "url", "body"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", False).load(path).select(F.col("file").cast("long").alias("file"), "content")
    return files.mapInPandas(run, "file long, ordinal long, start long, length long, sha string, url string, body binary")


def _file_of(page_id: Column, sha: Column, least: int, files: int) -> Column:
    spread = F.lit(files) + F.conv(F.substring(sha, 1, 5), 16, 10).cast("long")
    return F.coalesce(F.floor((page_id - least) / IDS_PER_FILE), spread)


def records(pages: DataFrame, least: int, files: int) -> DataFrame:
    """(file, ordinal, page_id, copy, start, length, sha): one row a record, without its bytes. copy numbers the rows of one id.

    Files are numbered from 0 for ids from `least` on; those from `files` on hold the rows without an id.
    """
    body = record_of(F.col("url"), F.col("html"))
    own = pages.select("page_id", F.octet_length(body).cast("long").alias("length"), F.sha2(body, 256).alias("sha"))
    own = own.withColumn("file", _file_of(_number(), F.col("sha"), least, files))
    order = Window.partitionBy("file").orderBy("page_id", "sha")
    row = own.withColumn("ordinal", (F.row_number().over(order) - 1).cast("long"))
    row = row.withColumn("start", F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
    return row.withColumn("copy", F.row_number().over(Window.partitionBy("file", "page_id").orderBy("sha")))


def leaves(recs: DataFrame) -> DataFrame:
    """Leaves (file, node, start, end, sha) of records."""
    end = F.col("start") + F.col("length")
    seal = F.sha2(F.concat_ws(":", F.col("start").cast("string"), end.cast("string"), F.col("sha")), 256)
    return recs.select("file", F.col("ordinal").alias("node"), "start", end.alias("end"), seal.alias("sha"))


def parents(nodes: DataFrame) -> DataFrame:
    """Parents of nodes (file, node, start, end, sha); at most FANOUT children meet in one row."""
    kids = F.array_sort(F.collect_list(F.struct("node", "start", "end", "sha")))
    up = nodes.groupBy("file", F.floor(F.col("node") / FANOUT).alias("node")).agg(kids.alias("kids"))
    spans = F.transform("kids", lambda k: F.concat_ws(":", k["start"].cast("string"), k["end"].cast("string"), k["sha"]))
    return up.select("file", "node", F.get("kids", F.lit(0))["start"].alias("start"), F.element_at("kids", -1)["end"].alias("end"), F.sha2(F.concat_ws("|", spans), 256).alias("sha"))


def height(largest: int) -> int:
    """Levels above one that numbers its nodes 0 .. largest, until one node is left."""
    up = 0
    while largest > 0:
        largest, up = largest // FANOUT, up + 1
    return up


def tree(recs: DataFrame, in_file: int, over_files: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels of the trees in files, leaves first, and of the tree over the files' roots (file is -1, node the file at first)."""
    inner = [materialise(leaves(recs), "leaves")]
    for _ in range(in_file):
        inner.append(materialise(parents(inner[-1]), "nodes"))
    outer = [inner[-1].select(F.lit(-1).cast("long").alias("file"), F.col("file").alias("node"), "start", "end", "sha")]
    for _ in range(over_files):
        outer.append(materialise(parents(outer[-1]), "nodes"))
    return inner, outer


def unequal(one: DataFrame, two: DataFrame, above: DataFrame | None) -> DataFrame:
    """(file, node) of a level where two replicas differ; below the nodes `above` only, if given."""

    def part(df: DataFrame, name: str) -> DataFrame:
        own = df.select("file", "node", F.col("sha").alias(name))
        if above is None:
            return own
        return own.withColumn("up", F.floor(F.col("node") / FANOUT)).join(above.select("file", F.col("node").alias("up")), ["file", "up"], "left_semi").drop("up")

    both = part(one, "p").join(part(two, "q"), ["file", "node"], "full")
    return materialise(both.where(~F.col("p").eqNullSafe(F.col("q"))).select("file", "node"), "unequal")


def differing(one: tuple[list[DataFrame], list[DataFrame]], two: tuple[list[DataFrame], list[DataFrame]]) -> DataFrame:
    """(file, node) of the leaves that differ or stand on one side only, found from the roots down."""
    at = None
    for x, y in zip(reversed(one[1]), reversed(two[1]), strict=True):
        at = unequal(x, y, at)
    at = at.select(F.col("node").alias("file"), F.lit(0).cast("long").alias("node"))
    for x, y in list(zip(one[0], two[0], strict=True))[-2::-1]:
        at = unequal(x, y, at)
    return at


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """(page_id, file, ordinal, start, length, sha, status): one row for each record of primary, and for each that only replica has (status extra, its own place)."""
    ids = [df.agg(F.min(_number()).alias("a"), F.max(_number()).alias("b")).first() for df in (primary, replica)]
    least = min((r["a"] for r in ids if r["a"] is not None), default=0)
    files = 1 + (max((r["b"] for r in ids if r["b"] is not None), default=0) - least) // IDS_PER_FILE
    recs = [materialise(records(df, least, files), "records") for df in (primary, replica)]
    size = [df.agg(F.coalesce(F.max("ordinal"), F.lit(0)).alias("o"), F.coalesce(F.max("file"), F.lit(0)).alias("f")).first() for df in recs]
    in_file, over_files = height(max(r["o"] for r in size)), height(max(r["f"] for r in size))
    bad = differing(*(tree(df, in_file, over_files) for df in recs)).withColumnRenamed("node", "ordinal")
    p, q = (df.join(bad, ["file", "ordinal"], "left_semi") for df in recs)
    key = ["file", "id", "copy"]
    p, q = (df.withColumn("id", F.coalesce(F.col("page_id").cast("string"), F.lit("")))  for df in (p, q))
    met = p.select(*key, F.col("ordinal").alias("po"), F.col("sha").alias("ps")).join(q.select(*key, F.col("ordinal").alias("qo"), F.col("sha").alias("qs"), "page_id", "start", "length"), key, "full")
    status = F.when(F.col("qs").isNull(), "missing").when(F.col("ps").isNull(), "extra").when(F.col("ps") == F.col("qs"), "moved").otherwise("corrupt")
    met = materialise(met.withColumn("status", status), "met")
    told = met.where("po IS NOT NULL").select("file", F.col("po").alias("ordinal"), "status")
    out = recs[0].join(told, ["file", "ordinal"], "left").withColumn("status", F.coalesce("status", F.lit("ok")))
    columns = ["page_id", "file", "ordinal", "start", "length", "sha", "status"]
    extra = met.where("status = 'extra'").select("page_id", "file", F.col("qo").alias("ordinal"), "start", "length", F.col("qs").alias("sha"), "status")
    return out.select(columns).unionByName(extra.select(columns))


def damaged(pages: DataFrame) -> DataFrame:
    """A replica of pages with damage by rule on page_id: cut off, one byte changed, lost, and written twice."""
    n = _number()
    hurt = F.when(n % 101 == 7, F.substring("html", 1, 100)).when(n % 103 == 11, F.concat(F.lit("#"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    kept = pages.select("page_id", "url", hurt.alias("html")).where(~F.coalesce(n % 211 == 13, F.lit(False)))
    return kept.unionByName(pages.where(n % 401 == 31).select("page_id", "url", "html"))


def audited(pages: DataFrame) -> DataFrame:
    """`audit` of pages against `damaged` pages."""
    return audit(pages.select("page_id", "url", "html"), damaged(pages))
