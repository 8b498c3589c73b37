"""The registered queries: thin digests of what the operators return, and SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.llm.exact_dedup import dedup_exact
from corploom.llm.frames import table
from corploom.llm.merkle import folded, leaf_of, manifest, proof_hash
from corploom.llm.mixing import mix
from corploom.llm.near_dedup import dedup_near
from corploom.llm.passages import repeated_passages
from corploom.llm.prefix_trie import build, rebuilt, turns_of, with_ends
from corploom.llm.quality import judge
from corploom.llm.secret_scan import KINDS, scan_secrets
from corploom.llm.slack_packing import pack_slack
from corploom.llm.token_store import read_tokens, write_tokens
from corploom.llm.toxicity import score_toxicity
from corploom.llm.url_filter import judge_urls, path_of
from corploom.llm.warc import read_captures, write_warc
from corploom.session import scratch_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table(sf_dir, "documents"))


def _joined(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_documents(spark, sf_dir))
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *[n(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
        "n_layers",
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(_documents(spark, sf_dir)).drop("chars")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(table(sf_dir, "labels"))
    return score_toxicity(_documents(spark, sf_dir), labels)


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, root = _documents(spark, sf_dir), scratch_path(spark, "token-store")
    write_tokens(docs, root, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    kept = read_tokens(docs.select("doc_id"), root)
    return kept.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_slack(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return packed.drop("ids")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    write_warc(spark.read.parquet(table(sf_dir, "pages")), root)
    return read_captures(spark, root, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to"
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_near(_documents(spark, sf_dir)).drop("tie")


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document that holds a passage and one that holds it as well, either way round."""
    found = repeated_passages(_documents(spark, sf_dir))
    swapped = {"doc_id": "source_id", "start": "source_start", "end": "source_end"}
    swapped |= {b: a for a, b in swapped.items()}
    return found.unionByName(found.select(*[F.col(swapped.get(c, c)).alias(c) for c in found.columns]))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judge(_documents(spark, sf_dir)).select("doc_id", *counts, "base_failed", "kept")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(table(sf_dir, "conversations"))
    trie = build(rebuilt(turns_of(rows)))
    return with_ends(trie).withColumnRenamed("saved", "saved_tokens")


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = [F.col(f"f{i}") for i in range(len(FIELDS))]
    more = F.col("f3").cast("decimal(20,0)") + 1
    tampered = F.crc32(F.col("f0").cast("string")) % 7 == 0
    claimed = F.when(tampered, leaf_of([*own[:3], more, own[4]])).otherwise(leaf_of(own))
    found = manifest(_documents(spark, sf_dir), list(FIELDS), claimed=claimed)
    found = found.select(
        "doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"), folded(F.col("claimed"), F.col("proof")).alias("folded_root")
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list are the URLs of pages whose document, by its number in the path, has a label for bad."""
    pages = spark.read.parquet(table(sf_dir, "pages"))
    bad = spark.read.parquet(table(sf_dir, "labels")).where("toxic = 1 or quality = 0").select(F.col("doc_id").cast("string").alias("number")).distinct()
    listed = pages.select("url", F.regexp_extract(path_of(F.col("url")), "/([0-9]+)", 1).alias("number")).join(bad, "number", "left_semi")
    return judge_urls(pages, listed.select("url"), RULES)


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_token_store": op4_token_store,
    "op5_slack_packing": op5_slack_packing,
    "op6_warc": op6_warc,
    "op7_near_dedup": op7_near_dedup,
    "op8_passages": op8_passages,
    "op9_quality_rules": op9_quality_rules,
    "op10_mixing": op10_mixing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_url_filter": op13_url_filter,
}

ORACLES = {
    "op2_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents),
        g AS (
            SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id
            FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
    "op7_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n
            HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
        reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
        FROM documents d LEFT JOIN n USING (doc_id)
        JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)""",
    "op10_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(text, '') AS text,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
            FROM documents),
        k AS (
            SELECT doc_id, source, size,
                   -ln((CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5::DOUBLE)
                       / 281474976710656.0::DOUBLE)
                   / CASE WHEN size > 0 THEN size::DOUBLE
                          / (size + 20 * (length(text) - length(translate(text, '#*$%&|<>', '')))) ELSE 1.0 END AS key
            FROM d),
        s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
            FROM d GROUP BY source),
        l AS (
            SELECT *, (3 * source_size)::DOUBLE / weight AS per,
                   (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
            FROM s
            WINDOW before AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (
            SELECT source, source_size,
                   CASE WHEN per <= level THEN (3 * source_size)::DOUBLE
                        ELSE weight * (SELECT level FROM l WHERE per > level ORDER BY per LIMIT 1) END AS target
            FROM l),
        e AS (
            SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
        p AS (
            SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS budget,
                   sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS UNBOUNDED PRECEDING) - k.size AS passed
            FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
        SELECT doc_id, size, source_size, target,
               CAST(size * (epochs + CASE WHEN 2 * passed + size < 2 * budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM p""",
    "op11_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        c AS (
            SELECT conv_id, conv_id - conv_id % 5 AS base,
                   xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
                       lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                           lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM t)),
        own AS (
            SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
            UNION ALL
            SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
        r AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, role, text FROM own),
        p AS (
            SELECT conv_id, depth, strlen(text) AS size,
                   list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM r
            UNION ALL
            SELECT conv_id, 0, 0, []::STRUCT(role VARCHAR, text VARCHAR)[] FROM c),
        m AS (
            SELECT conv_id, depth, size, depth = max(depth) OVER (PARTITION BY conv_id) AS ends,
                   min(conv_id) OVER (PARTITION BY depth, prefix) AS node FROM p),
        n AS (
            SELECT node, depth, count(*) AS n_convs, any_value(size) AS size,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM m GROUP BY node, depth),
        up AS (
            SELECT DISTINCT a.node, a.depth, b.node AS parent FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.depth = a.depth - 1),
        kids AS (
            SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM up GROUP BY parent, depth),
        below AS (
            SELECT a.node, a.depth, sum(CASE WHEN k.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves,
                   sum((n.n_convs - 1) * n.size) AS saved
            FROM n JOIN m a ON a.conv_id = n.node AND a.depth <= n.depth
            LEFT JOIN kids k ON k.node = n.node AND k.depth = n.depth
            GROUP BY a.node, a.depth)
        SELECT n.node AS conv_id, CAST(n.depth AS BIGINT) AS depth, up.parent AS parent_conv_id, n.n_convs,
               coalesce(k.n_children, 0) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
               CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM n LEFT JOIN up ON up.node = n.node AND up.depth = n.depth
        LEFT JOIN kids k ON k.node = n.node AND k.depth = n.depth
        JOIN below b ON b.node = n.node AND b.depth = n.depth""",
    "op12_merkle_manifest": r"""
        WITH RECURSIVE f AS (
            SELECT doc_id, lang,
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS front,
                   coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS chars,
                   coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS more,
                   coalesce(strlen(text) || ':' || text, '-') AS body,
                   xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
                       lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                           lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 7 AS seventh
            FROM documents),
        leaves AS (
            SELECT doc_id, lang, sha256(front || chars || body) AS leaf,
                   sha256(front || CASE WHEN seventh = 0 THEN more ELSE chars END || body) AS claimed,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS idx
            FROM f),
        low AS (
            SELECT lang, 0 AS level, list(leaf ORDER BY idx) AS nodes FROM leaves GROUP BY lang
            UNION ALL
            SELECT lang, level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
            FROM low WHERE len(nodes) > 1),
        subroots AS (
            SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx FROM low WHERE len(nodes) = 1),
        high AS (
            SELECT 0 AS level, list(subroot ORDER BY idx) AS nodes FROM subroots
            UNION ALL
            SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
            FROM high WHERE len(nodes) > 1),
        steps AS (
            SELECT l.doc_id, w.level AS step, (l.idx >> w.level) & 1 AS right_side,
                   coalesce(w.nodes[xor(l.idx >> w.level, 1) + 1], '') AS sibling
            FROM leaves l JOIN low w ON w.lang IS NOT DISTINCT FROM l.lang AND len(w.nodes) > 1
            UNION ALL
            SELECT l.doc_id, 1000 + h.level, (s.idx >> h.level) & 1, coalesce(h.nodes[xor(s.idx >> h.level, 1) + 1], '')
            FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang JOIN high h ON len(h.nodes) > 1),
        proofs AS (
            SELECT doc_id, list({'r': right_side, 's': sibling} ORDER BY step) AS proof, string_agg(sibling, '' ORDER BY step) AS joined
            FROM steps GROUP BY doc_id),
        fold AS (
            SELECT l.doc_id, l.claimed AS hash, 1 AS k FROM leaves l
            UNION ALL
            SELECT f.doc_id, sha256(CASE WHEN p.proof[k].r = 1 THEN p.proof[k].s || f.hash ELSE f.hash || p.proof[k].s END), k + 1
            FROM fold f JOIN proofs p USING (doc_id) WHERE k <= len(p.proof))
        SELECT l.doc_id, l.leaf, s.subroot, (SELECT nodes[1] FROM high WHERE len(nodes) = 1) AS root,
               sha256(coalesce(p.joined, '')) AS proof_sha256, f.hash AS folded_root,
               f.hash = (SELECT nodes[1] FROM high WHERE len(nodes) = 1) AS verified
        FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
        LEFT JOIN proofs p USING (doc_id) JOIN fold f ON f.doc_id = l.doc_id AND f.k = coalesce(len(p.proof), 0) + 1""",
    "op13_url_filter": r"""
        WITH u AS (
            SELECT page_id, url, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
                   coalesce(regexp_extract(url, '^(?s:.*?)://[^?#]*\?([^#]*)', 1), '') AS query
            FROM pages),
        n AS (
            SELECT *, list_sort(list_filter(string_split(query, '&'),
                       lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid|mc_cid|mc_eid)(=|$)'))) AS params
            FROM u),
        c AS (
            SELECT page_id, host, path, CASE WHEN host <> '' THEN
                   regexp_replace(regexp_replace(host, '^.*@|:(80|443)$|\.$', '', 'g'), '^www\.', '')
                   || regexp_replace(regexp_replace(regexp_replace(path, '/+', '/', 'g'), '/index\.html?$|\.html?$', ''), '/$', '')
                   || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS name
            FROM n),
        bad AS (
            SELECT DISTINCT name FROM c
            WHERE name IS NOT NULL AND regexp_extract(path, '/([0-9]+)', 1)
                  IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE (toxic = 1 OR quality = 0) AND doc_id IS NOT NULL)),
        rules AS (
            SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) v(verdict, host, path)),
        best AS (
            SELECT c.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
                   arg_max(r.verdict, length(r.host || r.path)) AS verdict
            FROM c JOIN rules r ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)
            GROUP BY c.page_id)
        SELECT c.page_id, c.host, c.path, b.rule, bad.name IS NOT NULL AS listed,
               coalesce(b.verdict, CASE WHEN bad.name IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
        FROM c LEFT JOIN best b USING (page_id) LEFT JOIN bad ON bad.name = c.name""",
}
