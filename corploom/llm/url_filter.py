"""URL filter: a blocked Bloom filter of listed URLs, an exact join for its hits, and rules.

Listed URLs are brought to one form and put into a blocked Bloom filter: a URL's hash names one
block of 256 bits, in which it sets one bit in each of eight lanes. Blocks are made by a bitwise
or for each block, so the list never meets in one task, and are broadcast in segments. The filter has
``BITS`` bits for each URL and ``MAX_BLOCKS`` blocks (64 MB) at most: for longer lists it lets
more URLs pass, and results stay the same, since whatever passes is joined with the list by
the whole form of the URL. URLs that do not pass are in the list for certain not, and are moved nowhere.

Rules are hosts with a path, ``example.org/es/``: a rule fits its host and all subdomains where the path
begins with the rule's. The longest rule that fits decides (of equal lengths that of the longer host, then
the one given later); where none does a URL is blocked if it is listed. At most ``MAX_RULES`` rules are
taken, since they become one expression; the list is the place for more.

A URL's host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z
lower-cased, its path what follows up to ``?``, ``#`` or the end. Null and empty URLs and those without ``://``
have an empty host and path, fit no rule and are not listed. Every row is judged by itself, so repeated rows
and URLs give repeated results; long URLs are taken whole. Nulls in the list and repeated entries
change nothing; an empty list blocks nothing and an empty table gives an empty result. Only the named columns
are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.llm.frames import pick
from corploom.session import stage

BITS = 12
MAX_BLOCKS = 1 << 21
SEGMENT = 1 << 12  # blocks in a broadcast row
MAX_RULES = 1000
LANES = 8
# odd multipliers of 31 bits, so that products of 32-bit numbers stay in a long
SALTS = [(0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64)) >> 33 | 1 for i in range(LANES)]
# Parameters that say where a visitor came from, not which page it is.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid|mc_cid|mc_eid)(=|$)"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One form for the URLs of a page: without scheme, user, default port, ``www.``, tracking
    parameters and fragment; parameters sorted; the path without doubled slashes, ``index.html``,
    a last ``.html`` and a last slash. Null where there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^.*@|:(80|443)$|\.$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), "/+", "/"), r"/index\.html?$|\.html?$", "")
    query = F.regexp_extract(url, r"^(?s:.*?)://[^?#]*\?([^#]*)", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    asked = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, F.regexp_replace(path, "/$", ""), asked))


def _block(key: Column, blocks: int) -> Column:
    return F.shiftrightunsigned(key, 32) % blocks


def _masks(key: Column) -> list[Column]:
    """Four longs with a bit in each of their two lanes."""
    low = key.bitwiseAND(F.lit(0xFFFFFFFF))
    at = [F.shiftrightunsigned((low * salt).bitwiseAND(F.lit(0xFFFFFFFF)), 27) for salt in SALTS]
    bit = lambda place: F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))
    return [bit(a).bitwiseOR(bit(b + 32)) for a, b in zip(at[::2], at[1::2])]


def bloom(keys: DataFrame, n: int) -> tuple[DataFrame, int]:
    """``(segment, words)`` of the filter over the hashes ``key`` of ``n`` rows, and its number of blocks, a
    power of two that grows with ``n`` up to ``MAX_BLOCKS``."""
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * 256 < n * BITS:
        blocks *= 2
    words = [f"w{i}" for i in range(LANES // 2)]
    none = keys.sparkSession.range(blocks).select(F.col("id").alias("block"), *[F.lit(0).cast("bigint").alias(w) for w in words])
    held = keys.select(_block(F.col("key"), blocks).alias("block"), *[m.alias(w) for w, m in zip(words, _masks(F.col("key")))])
    each = held.unionByName(none).groupBy("block").agg(*[F.bit_or(w).alias(w) for w in words])
    # SEGMENT rows a group
    row = F.array_sort(F.collect_list(F.struct("block", F.array(*words).alias("words"))))
    segments = each.groupBy(F.floor(F.col("block") / SEGMENT).alias("segment")).agg(row.alias("rows"))
    return segments.select("segment", F.flatten(F.col("rows")["words"]).alias("words")), blocks


def may_hold(rows: DataFrame, key: Column, segments: DataFrame, blocks: int, out: str) -> DataFrame:
    """``rows`` with whether the filter lets them pass; rows with a null ``key`` do not."""
    block = _block(key, blocks)
    at = (block % SEGMENT * (LANES // 2)).cast("int")
    inside = F.lit(True)
    for i, mask in enumerate(_masks(key)):
        inside &= F.get(F.col("words"), at + i).bitwiseAND(mask) == mask
    joined = rows.join(F.broadcast(segments), F.floor(block / SEGMENT) == F.col("segment"), "left")
    return joined.withColumn(out, F.coalesce(inside, F.lit(False))).drop("segment", "words")


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The rule that decides and its verdict, both null where none fits. ``rules`` are pairs of a verdict
    and a host with a path."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; more than {MAX_RULES} belong in the list")
    parts = []
    for k, (verdict, rule) in enumerate(rules):
        name, slash, rest = rule.partition("/")
        if not name:
            raise ValueError(f"a rule needs a host: {rule!r}")
        parts.append(((len(rule), len(name), k), name, slash + rest, rule, verdict))
    which = verdicts = None
    for _, name, start, rule, verdict in sorted(parts, reverse=True):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        which = F.when(fits, F.lit(rule)) if which is None else which.when(fits, F.lit(rule))
        verdicts = F.when(fits, F.lit(verdict)) if verdicts is None else verdicts.when(fits, F.lit(verdict))
    none = F.lit(None).cast("string")
    return (none, none) if which is None else (which, verdicts)


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
) -> DataFrame:
    """One row per page: ``id``, ``host``, ``path``, ``rule`` (null if none fits), ``listed`` and
    ``verdict`` (``allow`` or ``block``). The list is staged; the caller's job deletes it."""
    names = pick(listed, url=listed_col).select(canonical(F.col("url")).alias("name")).where("name is not null").distinct()
    names = stage(names, "listed-urls")
    segments, blocks = bloom(names.select(F.xxhash64("name").alias("key")), names.count())
    segments = stage(segments, "listed-filter")

    rows = pick(pages, id=id_col, url=url_col)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = rows.select("id", host.alias("host"), path.alias("path"), canonical(F.col("url")).alias("name"))
    key = F.when(F.col("name").isNotNull(), F.xxhash64("name"))
    rows = may_hold(rows, key, segments, blocks, "_maybe")
    # a URL of very many pages is one row of the list, so its pages may be split over tasks
    hits = rows.where("_maybe").join(names.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "name", "left")
    both = hits.unionByName(rows.where(~F.col("_maybe")).withColumn("listed", F.lit(False)))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    is_listed = F.coalesce("listed", F.lit(False))
    return both.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        rule.alias("rule"),
        is_listed.alias("listed"),
        F.coalesce(verdict, F.when(is_listed, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
