"""URL filter: blocked Bloom filter, then an exact join (operator 8).

Listed URLs and probed URLs are brought to one canonical form.  The filter is
a table of 512-bit blocks: a URL's hash picks one block and ``PROBES`` bits in
it, and the blocks are built by a bitwise-or aggregate.  Only URLs whose bits
are all set go on to the exact join with the list, which removes the false
positives; the rest cannot be listed.  The filter grows with the list up to
``MAX_BLOCKS`` blocks, which bounds what is broadcast; beyond that it lets
more through and the join, never the result, takes the load.

Rules by host and path come before the list; the longest matching rule wins.

Defined cases: a URL that is NULL or lacks ``://`` has an empty host and path,
matches no rule and no list entry; an empty list blocks nothing; repeated list
entries count once; repeated rows are rows of their own; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import prepare, stored

BITS_PER_URL = 16
PROBES = 6
BLOCK_WORDS = 8
MAX_BLOCKS = 1 << 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parameters that name a campaign or a referrer, not a page.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "ref")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for NULL or without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.`` and port 80/443, path without a trailing slash, sorted other parameters.

    The scheme, the fragment and the ``TRACKING`` parameters do not tell pages
    apart.  NULL where there is no host.
    """
    rest = _rest(url)
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    named = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.split(p, "=")[0].isin(*TRACKING))
    wanted = F.array_join(F.array_sort(named), "&")
    return F.when(host != "", F.concat(host, F.lit("/"), F.ltrim(path, F.lit("/")),
                                       F.when(wanted != "", F.concat(F.lit("?"), wanted)).otherwise("")))


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _masks(url: Column) -> list[Column]:
    """The bits of a URL inside its block, as ``BLOCK_WORDS`` longs."""
    spread = F.xxhash64(F.lit("bits"), url)
    bits = [F.pmod(F.shiftright(spread, 9 * k), F.lit(64 * BLOCK_WORDS)).cast("int") for k in range(PROBES)]
    words = []
    for w in range(BLOCK_WORDS):
        mask = F.lit(0).cast("long")
        for b in bits:
            one = F.call_function("shiftleft", F.lit(1).cast("long"), b.bitwiseAND(63))
            inside = F.when(F.shiftright(b, 6) == w, one)
            mask = mask.bitwiseOR(F.coalesce(inside, F.lit(0).cast("long")))
        words.append(mask)
    return words


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter: a row (block, w0..w7) for each block that has a bit set; ``listed`` has a column ``key``."""
    with_bits = listed.select(_block(F.col("key"), blocks).alias("block"),
                              *(m.alias(f"w{k}") for k, m in enumerate(_masks(F.col("key")))))
    return with_bits.groupBy("block").agg(*(F.bit_or(f"w{k}").alias(f"w{k}") for k in range(BLOCK_WORDS)))


def blocks_for(n: int) -> int:
    """Blocks for ``n`` listed URLs, between 1 and ``MAX_BLOCKS``."""
    return min(MAX_BLOCKS, max(1, -(-n * BITS_PER_URL // (64 * BLOCK_WORDS))))


def listed_rows(urls: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with a column ``in_list``: whether the canonical URL is one of ``listed``."""
    prepare(urls.sparkSession)
    keys = stored(listed.select(canonical(F.col(url)).alias("key")).where(F.col("key").isNotNull()).distinct(), "url-list")
    blocks = blocks_for(keys.count())
    bloom = F.broadcast(bloom_blocks(keys, blocks).select(F.col("block").alias("_b"),
                                                          *(F.col(f"w{k}").alias(f"_w{k}") for k in range(BLOCK_WORDS))))
    probe = urls.withColumn("_key", canonical(F.col(url)))
    fits = F.lit(True)
    for k, m in enumerate(_masks(F.col("_key"))):
        fits = fits & (F.col(f"_w{k}").bitwiseAND(m) == m)
    checked = (probe.join(bloom, _block(F.col("_key"), blocks) == F.col("_b"), "left")
               .withColumn("_maybe", F.coalesce(fits, F.lit(False)) & F.col("_key").isNotNull())
               .drop("_b", *(f"_w{k}" for k in range(BLOCK_WORDS))))
    exact = keys.select(F.col("key").alias("_listed"))
    hits = (checked.where("_maybe").join(exact, F.col("_key") == F.col("_listed"), "left")
            .withColumn("in_list", F.col("_listed").isNotNull()).drop("_listed"))
    misses = checked.where(~F.col("_maybe")).withColumn("in_list", F.lit(False))
    return hits.unionByName(misses).drop("_key", "_maybe")


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, ``host/path``) that fits; NULLs for none."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, written in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = written.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(written)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict and in_list for every row of ``pages`` (page_id, url)."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    seen = listed_rows(rows, listed).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("in_list"), F.lit("block")).otherwise("allow")
    return seen.select("page_id", "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, method).alias("verdict"), "in_list")
