"""Site-relative line dedup: lines that too many pages of one host share are boilerplate.

Pages are grouped by host. For each line the pages of its host that hold it are counted; a line on
more than ``ratio`` of the host's pages, and on two at least, is dropped wherever it stands on that
host. So a host with one page keeps all, as do pages without a host.

Column functions only. Pages are parsed and their lines written once. Lines travel as 64-bit hashes:
(host, line) counts are summed before the shuffle. What a host drops is a set of at most (distinct
lines of its mean page / ratio) hashes, looked up within each page, so no line is shuffled to be
dropped. Hosts with more than one in ``HOT_SHARE`` of all pages, of which there are fewer than
``HOT_SHARE``, are broadcast as a list, and their pages are spread over ``SALTS`` keys; so are pages
without a host.

Defined results: a null or empty text has no lines; a line counts once for each page, blank lines
are no lines; lines are compared trimmed. A script, style or comment without an end reaches to the
end of the page; a tag ends before the next one starts. Repeated rows are pages of their own.
``carry`` names what of the input travels along in ``row``; other columns are not read.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.llm.text import BLANKS
from galewire.sources.scratch import materialize

RATIO = 0.2
LEAST_HOLDING = 2  # pages of a host that must hold a line
HOT_SHARE = 1000
SALTS = 64

# Each pattern is left at its first mismatch or runs to the end once: pages are parsed in linear time.
UNSEEN = (
    r"(?is)<script\b[^<>]*>.*?(?:</script>|\z)|<style\b[^<>]*>.*?(?:</style>|\z)|<!--.*?(?:-->|\z)"
)
BREAKS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|"
    r"li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^<>]*>"
)
TAGS = r"<[^<>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def html_lines(html: Column) -> Column:
    """A page as text lines: a break at every block tag, other tags, scripts and comments gone."""
    text = F.regexp_replace(html, UNSEEN, "")
    for pattern, new in ((BREAKS, "\n"), (TAGS, "")):
        text = F.regexp_replace(text, pattern, new)
    return text_lines(text)


def text_lines(text: Column) -> Column:
    trimmed = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))
    return F.filter(trimmed, lambda x: x != "")


def url_host(url: Column) -> Column:
    """The host, lowered; null where there is none."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def drop_site_lines(
    pages: DataFrame,
    host: Column,
    lines: Column,
    carry: Sequence[str] = ("page_id",),
    ratio: float = RATIO,
) -> DataFrame:
    """``row``, ``host``, ``host_pages``, ``n_lines``, and ``kept_lines`` in their order."""
    row = F.struct(*[F.col(f"`{c}`") for c in carry])
    base = materialize(
        pages.select(row.alias("row"), host.alias("host"), lines.alias("lines")).select(
            "*", F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes")
        ),
        "site-lines",
    )
    totals = base.filter("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = (
        base.filter("host IS NOT NULL")
        .select("host", F.explode(F.array_distinct("hashes")).alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= LEAST_HOLDING)
    )
    frequent = (
        counts.join(totals, "host")
        .filter(F.col("n") > F.lit(ratio) * F.col("host_pages"))
        .groupBy("host")
        .agg(F.collect_set("line").alias("frequent"))
    )
    sites = materialize(totals.join(frequent, "host", "left"), "sites")
    hot = F.col("host_pages") * HOT_SHARE > F.lit(base.count())
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = F.pmod(F.xxhash64("hashes", "row"), F.lit(SALTS)).cast("int")
    hosts = F.broadcast(sites.filter(hot).select("host", F.lit(True).alias("_hot")))  # fewer than HOT_SHARE rows
    salted = base.join(hosts, "host", "left").withColumn(
        "salt", F.when(F.col("_hot") | F.col("host").isNull(), spread).otherwise(0)
    )
    kept = F.when(F.col("frequent").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains(F.col("frequent"), F.xxhash64(x)))
    )
    return salted.join(sites.withColumn("salt", F.explode(salts)), ["host", "salt"], "left").select(
        "row", "host", F.coalesce("host_pages", F.lit(0)).cast("long").alias("host_pages"),
        F.size("lines").cast("long").alias("n_lines"), kept.alias("kept_lines"),
    )
