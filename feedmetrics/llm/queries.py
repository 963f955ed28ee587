"""The corpus operators as queries over whole tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmetrics.llm import (alignment, exact_dedup, minmax, mixing, packing, ppm, prefix_trie, quality_fm, rule_cascade, sharding, simhash,
                             substring_dedup, warc)
from feedmetrics.session import configure, scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return build

    return register


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_quality_classifier")
def quality_scores(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    machine = quality_fm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_fm.scored(docs.select("doc_id", "text", "n_chars"), machine).select(
        "doc_id", "held_out", "score", "predicted")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_pack")
def pack_documents(spark, sf_dir):
    return packing.pack(_documents(spark, sf_dir), tokenizer_file(), end_id=2)


@query("op3_quality_rules", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (SELECT r, p, list_slice(words, p, p + 7) AS seq
            FROM (SELECT r, words, unnest(generate_series(1, len(words) - 7)) AS p FROM w)),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, seq) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p + k) AS n FROM twice, generate_series(0, 7) AS g(k) GROUP BY r),
c AS (SELECT doc_id, t, words, lines, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: len(x))), 0) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(covered.n, 0) AS n_repeat_words
      FROM w LEFT JOIN covered USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words
            OR 2 * n_dup_lines > len(lines)
            OR 10 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < 7 * n_words
            OR len(regexp_extract_all(t, '[A-Z]')) > len(regexp_extract_all(t, '[a-z]'))
            OR 10 * len(list_filter(list_zip(words, words[2:]), lambda x: x[1] = x[2])) > 3 * n_words
            OR 10 * len(list_filter(lines, lambda x: x LIKE '%...' OR x LIKE '%…')) > 3 * len(lines)
            OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^[-*•]'))) > 9 * len(lines)) AS kept
FROM f""")
def quality_rules(spark, sf_dir):
    return rule_cascade.judged(_documents(spark, sf_dir))


@query("op4_simhash_dedup")
def simhash_dedup(spark, sf_dir):
    return simhash.near_duplicates(_documents(spark, sf_dir))


MIX_CYCLE, MIX_CAP, MIX_BLOCK, MIX_SHARD, MIX_SHARD_WORDS, MIX_SEED = (5, 2, 1), 3, 16, 5_000, 16_000, 1


@query("op5_mix_sources", f"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{MIX_SEED}/' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents),
totals AS (SELECT sum(size)::BIGINT AS total, greatest((count(*) + {MIX_SHARD - 1}) // {MIX_SHARD}, 1) AS shards_each,
                  ((2 * sum(size) + {MIX_BLOCK}) // {2 * MIX_BLOCK})::BIGINT AS blocks FROM docs),
own AS (SELECT source, least(greatest((count(*) FILTER (WHERE size > 0) + {MIX_SHARD - 1}) // {MIX_SHARD},
               sum(size)::BIGINT // {MIX_SHARD_WORDS}, 1), any_value(shards_each)) AS shards
        FROM docs, totals GROUP BY source),
d AS (SELECT doc_id, docs.source, size, CASE WHEN size > 0 THEN ('0x' || substr(digest, 1, 8))::BIGINT % shards
             ELSE -1 - ('0x' || substr(digest, 1, 8))::BIGINT % shards_each END AS shard,
             substr(digest, 9, 24) AS place
      FROM docs JOIN own ON own.source IS NOT DISTINCT FROM docs.source, totals),
sh AS (SELECT source, shard, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
named AS (SELECT source, sum(words)::BIGINT AS source_size,
                 [{', '.join(map(str, MIX_CYCLE))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1)
                 % {len(MIX_CYCLE)} + 1)::INT]::BIGINT AS weight
          FROM sh GROUP BY source),
leveled AS (
  SELECT named.*, (total - coalesce(sum({MIX_CAP} * source_size) OVER (ORDER BY {MIX_CAP} * source_size / weight,
           source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT
         / (sum(weight) OVER (ORDER BY {MIX_CAP} * source_size / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM named, totals),
t AS (SELECT source, source_size,
             CASE WHEN level * weight >= {MIX_CAP} * source_size THEN ({MIX_CAP} * source_size)::DOUBLE
             ELSE max(CASE WHEN level * weight < {MIX_CAP} * source_size THEN level END) OVER () * weight END AS target
      FROM leveled),
seats AS (SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST) AS n
          FROM t, (SELECT unnest(generate_series(0, blocks)) AS k FROM totals) WHERE target > 0),
q AS (SELECT t.source, t.source_size, t.target, least(count(s.n), ({MIX_CAP} * t.source_size + {MIX_BLOCK - 1}) // {MIX_BLOCK}) AS quota
      FROM t, totals LEFT JOIN seats s ON s.source IS NOT DISTINCT FROM t.source AND s.n <= blocks
      GROUP BY t.source, t.source_size, t.target),
seats2 AS (SELECT sh.source, sh.shard, row_number() OVER (PARTITION BY sh.source
             ORDER BY sh.words / (2 * k + 1) DESC, sh.shard) AS n
           FROM sh JOIN q ON q.source IS NOT DISTINCT FROM sh.source, unnest(generate_series(0, q.quota)) AS g(k)
           WHERE sh.words > 0),
runs AS (
  SELECT sh.source, sh.shard, words, source_size, target,
         (('0x' || substr(md5(concat_ws('/', '{MIX_SEED}', (sh.source IS NULL)::INT::VARCHAR, coalesce(sh.source, ''),
           sh.shard::VARCHAR)), 1, 15))::BIGINT % greatest((words + {MIX_BLOCK - 1}) // {MIX_BLOCK}, 1)) * {MIX_BLOCK} AS b,
         CASE WHEN target >= {MIX_CAP} * source_size THEN {MIX_CAP} * words ELSE least((
           SELECT count(*) FROM seats2 s WHERE s.source IS NOT DISTINCT FROM sh.source AND s.shard = sh.shard
           AND s.n <= q.quota) * {MIX_BLOCK}, {MIX_CAP} * words) END AS run
  FROM sh JOIN q ON q.source IS NOT DISTINCT FROM sh.source),
ends AS (SELECT d.*, sum(size) OVER (PARTITION BY source, shard ORDER BY place, doc_id, size
                                     ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM d)
SELECT doc_id, ends.source, size, source_size, target,
       (CASE WHEN words > 0 THEN (b + run) // words * size + least(greatest((b + run) % words - (e - size), 0), size)
             - b // words * size - least(greatest(b % words - (e - size), 0), size) ELSE 0 END)::BIGINT AS taken
FROM ends JOIN runs ON runs.source IS NOT DISTINCT FROM ends.source AND runs.shard = ends.shard""")
def mix_sources(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return mixing.mix(docs, mixing.cyclic_weights(docs, MIX_CYCLE), cap=MIX_CAP, block_words=MIX_BLOCK,
                      shard_docs=MIX_SHARD, shard_words=MIX_SHARD_WORDS, seed=MIX_SEED)


@query("op6_exact_dedup", """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""")
def exact_duplicates(spark, sf_dir):
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir), keep="largest")


SHARDS, SLOTS = [f"shard-{i:03d}" for i in range(64)], 65_537


@query("op7_sharding", f"""
WITH placed AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(string_split('{",".join(map(str, sharding.lookup_table(SHARDS, SLOTS)))}',
       ',')[slot + 1], 3, '0') AS shard
FROM placed""")
def place_documents(spark, sf_dir):
    return sharding.shard_rows(_documents(spark, sf_dir).select("doc_id"), "doc_id", SHARDS, SLOTS)


@query("op8_warc", """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f""")
def warc_round_trip(spark, sf_dir):
    archive = scratch_dir(spark, "llm-warc")
    warc.write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), archive)
    return warc.pages_of(warc.read_archive(spark, archive))


@query("op9_lm_scoring")
def lm_scores(spark, sf_dir):
    return ppm.scored(_documents(spark, sf_dir))


@query("op10_substring_dedup", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT doc_id, p, array_to_string(list_slice(words, p, p + 19), ' ') AS seq
            FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS p FROM w)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY seq ORDER BY doc_id, p) AS nth
                                 FROM windows) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM later, generate_series(0, 19) AS g(k)),
each AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept_text, count(*) AS n
         FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id""")
def substring_duplicates(spark, sf_dir):
    found = substring_dedup.without_repeats(_documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op11_prefix_trie", r"""
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
         PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS nth
  FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k:
               CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS steps),
ids AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(
               string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
               lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM t), crc),
turns AS (SELECT conv_id, nth, r, x FROM t JOIN ids USING (conv_id) WHERE nth > h
          UNION ALL SELECT ids.conv_id, nth, r, x FROM ids JOIN t ON t.conv_id = ids.conv_id - ids.conv_id % 5 AND nth <= h),
s AS (SELECT ids.conv_id, coalesce(list({'r': r, 'x': x} ORDER BY nth) FILTER (r IS NOT NULL), []) AS seq
      FROM ids LEFT JOIN turns USING (conv_id) GROUP BY ids.conv_id),
prefixes AS (SELECT conv_id, d, md5(list_slice(seq, 1, d)::VARCHAR) AS p, seq,
                    CASE WHEN d > 0 THEN md5(list_slice(seq, 1, d - 1)::VARCHAR) END AS parent, len(seq) = d AS ends
             FROM (SELECT *, unnest(generate_series(0, len(seq))) AS d FROM s)),
nodes AS (SELECT p, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n,
                 coalesce(any_value(octet_length(encode(seq[d].x))), 0) AS bytes,
                 coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends
          FROM prefixes GROUP BY p, d),
children AS (SELECT parent AS p, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
up AS (SELECT p AS node, p AS top, parent FROM nodes
       UNION ALL SELECT up.node, nodes.p, nodes.parent FROM up JOIN nodes ON nodes.p = up.parent),
sums AS (SELECT up.top AS p, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n - 1) * bytes) AS saved
         FROM up JOIN nodes ON nodes.p = up.node LEFT JOIN children ON children.p = up.node GROUP BY up.top)
SELECT nodes.conv_id, nodes.d::BIGINT AS depth, above.conv_id AS parent_conv_id, nodes.n AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
       sha256(nodes.ends) AS ends_sha256
FROM nodes JOIN sums USING (p) LEFT JOIN children USING (p) LEFT JOIN nodes above ON above.p = nodes.parent""")
def conversation_prefixes(spark, sf_dir):
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op12_minmax_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, list_sort(CASE WHEN len(words) < 2 THEN words ELSE list_distinct(list_transform(
             generate_series(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1])) END) AS members FROM w),
classes AS (SELECT members, min(doc_id) AS node, len(members) AS n FROM s WHERE len(members) > 0 GROUP BY members),
each AS (SELECT node, n, unnest(members) AS shingle FROM classes),
links AS (SELECT a.node AS a, b.node AS b FROM each a JOIN each b ON a.shingle = b.shingle AND a.node < b.node
          AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
          GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT node AS a, node AS b FROM classes
          UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.b),
roots AS (SELECT a AS node, min(b) AS root FROM reach GROUP BY a)
SELECT doc_id, len(s.members)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id,
       doc_id = coalesce(root, doc_id) AS kept
FROM s LEFT JOIN classes ON classes.members = s.members LEFT JOIN roots USING (node)""")
def minmax_duplicates(spark, sf_dir):
    return minmax.near_duplicates(_documents(spark, sf_dir))


@query("op13_tokenizer_alignment")
def align_tokenizers(spark, sf_dir):
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    found = alignment.aligned(
        _documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"),
        keep=lambda rows: rows.select("block", "doc_id", "n_a", "n_b", "n_groups", digest, "links", "a", "b", "n"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
