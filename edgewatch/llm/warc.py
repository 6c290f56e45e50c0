"""WARC archives: written by Spark's text writer, read back by verifying the chain of record boundaries.

Reading splits files at the magic. Every magic is a candidate record start with a successor: the offset
that its header and ``Content-Length`` lead to. Only candidates on the chain from the start of the file
are records; a magic inside a payload is a candidate that nothing reachable leads to. Candidates are
first followed inside their file block, then the exits of the blocks are joined by pointer jumping.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgewatch.llm.rows import column
from edgewatch.session import materialize

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 1000
MAX_RECORDS = 20_000


# --- writing -----------------------------------------------------------------------------------


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def revisits(keyed: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, digest, refers_to`` of the rows whose payload another row of a larger id holds.

    ``keyed`` has ``page_id, bytes, digest``. A null id is smaller than any other.
    """
    large = keyed.filter(F.col("bytes") >= min_bytes)
    groups = large.groupBy("digest").agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")
    )
    groups = groups.filter("n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to")
    joined = large.join(groups, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return joined.select("page_id", "digest", "refers_to").distinct()


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    min_bytes: int = MIN_REVISIT_BYTES,
    max_records: int = MAX_RECORDS,
) -> None:
    """One record per row, in new WARC files under ``path``.

    The payload is the page in UTF-8, null as empty. Of equal payloads of ``min_bytes`` or more, rows of
    the largest id are responses and the others revisit it; repeated rows of that id are responses each.
    Line breaks in a URL become spaces, a null URL is left out.
    """
    page_id = column(pages, id_col).cast("long")
    html = F.coalesce(column(pages, html_col), F.lit(""))
    rows = pages.select(page_id.alias("page_id"), column(pages, url_col).alias("url"), html.alias("html"))
    rows = rows.withColumns({"bytes": F.octet_length("html"), "digest": F.sha1(F.col("html").cast("binary"))})
    again = materialize(
        revisits(materialize(rows.select("page_id", "bytes", "digest"), "payloads"), min_bytes), "revisits"
    )
    # by id and digest, so that the copies of a frequent payload stay spread
    joined = rows.alias("r").join(
        again.alias("a"),
        F.col("r.page_id").eqNullSafe(F.col("a.page_id")) & (F.col("r.digest") == F.col("a.digest")),
        "left",
    ).select("r.*", "a.refers_to")
    refers = F.col("refers_to")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit(END),
    )
    block = F.concat(http, F.when(refers.isNull(), F.col("html")).otherwise(""))
    record = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(refers.isNull(), "response").otherwise("revisit")),
        _line("WARC-Record-ID", _page_urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        F.coalesce(
            _line("WARC-Target-URI", F.concat(F.lit("<"), F.regexp_replace("url", r"[\r\n]+", " "), F.lit(">"))),
            F.lit(""),
        ),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(refers.isNull(), F.lit("")).otherwise(
            F.concat(_line("WARC-Profile", F.lit(IDENTICAL)), _line("WARC-Refers-To", _page_urn(refers)))
        ),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block,
    )
    writer = joined.select(record.alias("value")).write.option("lineSep", END)
    writer.option("maxRecordsPerFile", max_records).text(path)


# --- reading -----------------------------------------------------------------------------------


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between two magics, in the order of ``file, block, turn``."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("turn"),
        "value",
    )


def _field(head: Column, name: str, pattern: str = "[^\r\n]*?") -> Column:
    """A header's value, null where the header is missing."""
    found = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*({pattern})[ \t]*(?:\r\n|$)", 1)
    return F.when(found != "", found)


def _after(value: Column, start: Column, size: Column | int = 2**31 - 1) -> Column:
    """Bytes from a 0-based offset on."""
    return F.substring(value.cast("binary"), start + F.lit(1), F.lit(size) if isinstance(size, int) else size)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment: its place, its lengths, and the record that would start with it.

    ``bytes`` and ``digest`` are those of the payload if the record ends with the segment (``whole``).
    Text that has no complete header with a length has a null ``head`` and leads nowhere.
    """
    head = F.substring_index("value", END, 1)
    size = F.when(F.octet_length(head) < F.octet_length("value"), _field(head, "Content-Length", r"\d{1,15}"))
    seen = _segments(spark, path).withColumns(
        {"length": F.octet_length("value").cast("long"), "size": size.cast("long")}
    )
    seen = seen.withColumn("head", F.when(F.col("size").isNotNull(), head))
    seen = seen.withColumn("body", F.octet_length("head") + len(END))
    seen = seen.withColumn("whole", F.coalesce(F.expr(f"body + size + {len(END)} = length"), F.lit(False)))
    block = F.when(F.col("whole"), _after(F.col("value"), F.col("body"), F.col("size").cast("int")))
    payload = _payload(block, F.col("head"))
    http = F.when(_is_http(F.col("head")), F.substring_index(block.cast("string"), END, 1))
    return materialize(
        seen.select(
            "file", "block", "turn", "length", "body", "size", "whole", "head",
            F.octet_length(payload).cast("long").alias("bytes"), F.sha1(payload).alias("digest"),
            _field(http, "Content-Length", r"\d{1,15}").cast("long").alias("stated_bytes"),
        ),
        "segments",
    )


def blocks_before(blocks: DataFrame) -> DataFrame:
    """``before``: bytes in the earlier blocks of a file; one small row per block and file."""
    listed = blocks.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("block", "total"))).alias("b"))
    exploded = listed.select("file", "b", F.posexplode("b").alias("i", "own"))
    before = F.aggregate(F.slice("b", F.lit(1), F.col("i")), F.lit(0).cast("long"), lambda s, x: s + x["total"])
    return exploded.select("file", F.col("own.block").alias("block"), before.alias("before"))


def _is_http(head: Column) -> Column:
    return F.coalesce(_field(head, "Content-Type"), F.lit("")).startswith("application/http")


def _payload(block: Column, head: Column) -> Column:
    """The block without the HTTP header, if the record says that it has one."""
    http = F.substring_index(block.cast("string"), END, 1)
    return F.when(_is_http(head), _after(block, F.octet_length(http) + len(END))).otherwise(block)


FOLLOWED = "file string, block long, turn long, offset long, succ long, exit long"
OWNED = "file string, block long, turn long, offset long, record boolean, succ long"


def _follow(frame: pd.DataFrame) -> pd.DataFrame:
    """Offsets of a block's candidates, their successors, and where each chain leaves the block."""
    frame = frame.sort_values("turn", kind="stable")
    m, length = len(MAGIC), frame["length"].to_numpy()
    offset = np.cumsum(length + m) - length - 2 * m + int(frame["before"].iloc[0])
    reach = frame["size"].astype("Int64") + frame["body"].astype("Int64") + m + len(END)
    succ = (reach + offset).fillna(-1).to_numpy(np.int64)
    exit_ = succ.copy()
    while True:  # each round doubles the jumps
        at = np.minimum(np.searchsorted(offset, exit_), len(offset) - 1)
        inside = offset[at] == exit_
        if not inside.any():
            break
        exit_ = np.where(inside, exit_[at], exit_)
    out = frame[["file", "block", "turn"]].assign(offset=offset, succ=succ, exit=exit_)
    return out[out["offset"] >= 0]


def _walk(chain: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
    """Which candidates of a block are records, and for each segment the end of the record it is in."""
    chain = chain.sort_values("offset")
    succ = dict(zip(chain["offset"].tolist(), chain["succ"].tolist(), strict=True))
    starts, at = [], int(entry["offset"].iloc[0])
    while at in succ:
        starts.append(at)
        at = succ[at]
    offsets = chain["offset"].to_numpy()
    limits = np.array([*starts, int(entry["upper"].iloc[0])], np.int64)
    owner = limits[np.searchsorted(np.array(starts, np.int64), offsets, side="right")]
    out = chain[["file", "block", "turn", "offset"]]
    return out.assign(record=np.isin(offsets, starts), succ=owner)


def owned_segments(rows: DataFrame) -> DataFrame:
    """``file, block, turn, offset, record, succ`` of every segment after a file's first magic.

    ``record``: the chain from the start of the file comes to it. ``succ``: the end of the record that
    it starts or lies in.
    """
    by = ["file", "block"]
    blocks = rows.groupBy(*by).agg(F.sum(F.col("length") + len(MAGIC)).alias("total"))
    before = materialize(blocks_before(blocks), "blocks")
    followed = materialize(rows.join(before, by).groupBy(*by).applyInPandas(_follow, FOLLOWED), "chains")
    jumps = followed.select("file", "offset", "block", F.col("exit").alias("to"))
    seen = materialize(jumps.filter("offset = 0"), "reached")
    # a block has one entry on the chain: as many rounds as the block count of the longest file has digits
    while True:
        a, b = jumps.alias("a"), jumps.alias("b")
        hop = (F.col("a.file") == F.col("b.file")) & (F.col("a.to") == F.col("b.offset"))
        found = seen.select("file", "offset").join(a.hint("merge"), ["file", "offset"])
        found = found.join(b.hint("merge"), hop).select("b.*")
        new = found.select("file", "offset").join(seen, ["file", "offset"], "left_anti")
        new = materialize(new.join(followed.hint("merge"), ["file", "offset"]), "reached")
        if new.isEmpty():
            break
        seen = seen.unionByName(new.select("file", "offset", "block", F.col("exit").alias("to")))
        seen = materialize(seen.dropDuplicates(["file", "offset"]), "reached")
        doubled = a.join(b.hint("merge"), hop, "left")
        jumps = materialize(
            doubled.select("a.file", "a.offset", "a.block", F.coalesce("b.to", "a.to").alias("to")), "jumps"
        )
    later = Window.partitionBy("file").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    last = Window.partitionBy("file")
    entries = before.join(seen, by, "left").select(
        *by,
        F.coalesce("offset", F.lit(-1)).alias("offset"),
        F.coalesce(F.min("offset").over(later), F.max("to").over(last), F.lit(-1)).alias("upper"),
    )
    return followed.groupBy(*by).cogroup(entries.groupBy(*by)).applyInPandas(_walk, OWNED)


def read_records(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of the archives under ``path`` (or a glob), verified from each file's start.

    ``file, offset, type, record_id, uri, refers_to, bytes, digest`` and, if asked for, ``payload``.
    ``bytes`` and ``digest`` are computed from the payload that the archive holds; for a revisit, whose
    payload is elsewhere, they are what its headers state. A record that the end of the file cuts off is
    returned with what there is of it; what follows a broken header in its file is not reachable and not
    returned. No line of a record's header may end with the magic.
    """
    rows = candidates(spark, path)
    by = ["file", "block", "turn"]
    owned = materialize(owned_segments(rows), "owned")
    # merged: these tables are small files of many rows, too many to be broadcast by their file size
    kept = materialize(owned.filter("record").drop("record").hint("merge").join(rows, by), "records")
    pieces = kept if payload else kept.filter("NOT whole")
    if payload or not pieces.isEmpty():
        wanted = pieces.select("file", "succ", "head", "body", "size")
        gathered = _gather(spark, path, owned.select(*by, "succ", F.col("offset").alias("at")), wanted)
        kept = kept.join(gathered, ["file", "succ"], "left").withColumns(
            {
                "bytes": F.coalesce(F.octet_length("payload").cast("long"), "bytes"),
                "digest": F.coalesce(F.sha1("payload"), "digest"),
            }
        )
    head = F.col("head")
    revisit = F.coalesce(F.lower(_field(head, "WARC-Type")) == "revisit", F.lit(False))
    stated = F.regexp_replace(_field(head, "WARC-Payload-Digest"), "^sha1:", "")
    return kept.select(
        "file",
        "offset",
        F.lower(_field(head, "WARC-Type")).alias("type"),
        _field(head, "WARC-Record-ID").alias("record_id"),
        F.regexp_replace(_field(head, "WARC-Target-URI"), "^<(.*)>$", "$1").alias("uri"),
        _field(head, "WARC-Refers-To").alias("refers_to"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("bytes")).alias("bytes"),
        F.when(revisit, stated).otherwise(F.col("digest")).alias("digest"),
        *(["payload"] if payload else []),
    )


def _gather(spark: SparkSession, path: str, owned: DataFrame, wanted: DataFrame) -> DataFrame:
    """``file, succ, payload``: the segments of each record put together again, magics between them."""
    parts = owned.join(wanted, ["file", "succ"])
    parts = _segments(spark, path).join(parts, ["file", "block", "turn"]).groupBy("file", "succ").agg(
        F.array_sort(F.collect_list(F.struct("at", F.col("value").cast("binary").alias("value")))).alias("parts"),
        F.first("head").alias("head"), F.first("body").alias("body"), F.first("size").alias("size"),
    )
    whole = F.aggregate(
        F.slice("parts", F.lit(2), F.size("parts")),
        F.element_at("parts", 1)["value"],
        lambda text, part: F.concat(text, F.lit(MAGIC.encode()), part["value"]),
    )
    block = F.substring(whole, F.col("body") + 1, F.col("size").cast("int"))
    return parts.select("file", "succ", _payload(block, F.col("head")).alias("payload"))


def page_id_of(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")


def scratch_path(base: str) -> str:
    return f"{base}/archives-{uuid.uuid4().hex}"
