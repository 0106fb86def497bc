"""The registered queries of the operators and their DuckDB equivalents.

Each query applies its operator to the whole ``documents`` table and derives
the digest columns from the operator's own output.  Operators that SQL cannot
express have no SQL here and are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm import (
    alignment, bilinear_lm, bpe, exact_dedup, line_dedup, merkle, mixing, ordinal, range_coder, resharding, rule_ledger,
    secret_ledger, simhash,
)
from tierlake.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


OLD_SHARDS, NEW_SHARDS = 12, 16


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 12 shards by source (one holds a third of all rows) to 16 equal ones."""
    old = F.pmod(F.xxhash64("source"), F.lit(OLD_SHARDS))
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    placed = resharding.reshard(docs, old, OLD_SHARDS, NEW_SHARDS)
    return placed.select(
        "doc_id", F.col("size").cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard")


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), tokenizer_path())


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = documents(spark, sf_dir).select("doc_id", "text")
    found = secret_ledger.scan(versions)

    def count(kind: str):
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_ledger.written(base), 256).alias("base_sha256"),
        secret_ledger.written(F.col("findings")).alias("spans"))


@query
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear_lm.score_documents(documents(spark, sf_dir))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = ordinal.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ordinal.label_grade(), ordinal.GRADES)
    return ordinal.score_documents(docs, model)


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_coder.written_and_read(documents(spark, sf_dir), tokenizer_path())


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = rule_ledger.read_ledger(spark, rule_ledger.store(documents(spark, sf_dir)))
    return rule_ledger.apply_policy(ledger).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "fail_bits")


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_blocks(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "blocks", "settled")


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(documents(spark, sf_dir))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(merkle.manifest(documents(spark, sf_dir)))


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"),
                                     tokenizer_path("piece_bpe_32k.model"))


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


# --- DuckDB SQL -------------------------------------------------------------------

def _secret_branch(r: secret_ledger.Rule, no: int) -> str:
    pattern = r.pattern.replace("'", "''")
    return f"""SELECT rid, '{r.kind}' AS kind, {no} AS no, {r.least} AS least,
       regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {r.group}) AS p,
       string_split_regex(t, '{pattern}') AS b FROM d"""


_SECRETS = " UNION ALL ".join(_secret_branch(r, i) for i, r in enumerate(secret_ledger.RULES))

ORACLE["op4_secret_scan"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
     found AS ({_SECRETS}),
     one AS (SELECT rid, kind, no, least, generate_subscripts(m, 1) AS i, unnest(m) AS m, unnest(p) AS p,
                    unnest(b[1:len(m)]) AS b FROM found WHERE len(m) > 0),
     placed AS (SELECT *, sum(length(b) + length(m)) OVER (PARTITION BY rid, kind ORDER BY i)::BIGINT AS stop FROM one),
     hit AS (SELECT rid, no, kind, stop - length(m) AS start, stop FROM placed WHERE length(p) >= least),
     per AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                    count(*) FILTER (kind = 'hex') AS n_hex,
                    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no) AS spans
             FROM hit GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (rid)
"""

_RULE_SQL = " + ".join(f"CASE WHEN {rule} THEN {1 << bit} ELSE 0 END"
                       for bit, rule in enumerate(rule_ledger.RULES.values()))

ORACLE["op8_quality_rules"] = fr"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
     w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
     tok AS (SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
     win AS (SELECT rid, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o AS s FROM tok
             WINDOW o AS (PARTITION BY rid ORDER BY i)),
     rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM win
                                 WHERE s IS NOT NULL) WHERE c > 1),
     cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS v(k) GROUP BY rid),
     m AS (SELECT doc_id, len(w)::BIGINT AS n_words, len(l)::BIGINT AS n_lines,
                  length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                  length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
                  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
                  coalesce(cov.n, 0)::BIGINT AS n_repeat_words
           FROM w LEFT JOIN cov USING (rid)),
     b AS (SELECT *, ({_RULE_SQL})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & {rule_ledger.BASE.mask} <> 0 AS base_failed,
       fail_bits & {rule_ledger.BASE.mask | rule_ledger.STRICT.mask} = 0 AS kept, fail_bits
FROM b
"""

_W = ", ".join(f"{float(x)}" for x in mixing.WEIGHTS)

ORACLE["op9_mixing"] = fr"""
WITH sizes AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                      md5(concat_ws(':', '{mixing.SEED}', doc_id::VARCHAR, md5(text))) AS h FROM documents),
     per AS (SELECT source, sum(size)::BIGINT AS source_size,
                    row_number() OVER (ORDER BY source NULLS LAST) AS source_no FROM sizes GROUP BY source),
     w AS (SELECT *, [{_W}][((source_no - 1) % {len(mixing.WEIGHTS)} + 1)::INT] AS weight,
                  source_size::DOUBLE * {float(mixing.MAX_REPEATS)} AS cap,
                  (sum(source_size) OVER ())::DOUBLE * {mixing.SHARE} AS budget FROM per),
     lv AS (SELECT *, greatest(0.0::DOUBLE, budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
                   row_number() OVER o AS k FROM w WINDOW o AS (ORDER BY cap / weight, source_no)),
     fr AS (SELECT arg_min(level, k) AS level FROM lv WHERE level * weight < cap),
     t AS (SELECT source, source_no, source_size,
                  CASE WHEN fr.level IS NULL THEN cap ELSE least(cap, fr.level * weight) END AS target
           FROM lv LEFT JOIN fr ON true),
     tb AS (SELECT *, greatest(1, ceil(sum(target) OVER () / {mixing.TOTAL_BLOCKS}))::BIGINT AS block,
                   round(target)::BIGINT AS words FROM t),
     ts AS (SELECT *, round(sum(target) OVER () / block)::BIGINT AS slots,
                   ceil(source_size / block::DOUBLE)::BIGINT AS n_blocks FROM tb),
     q AS (SELECT *, unnest(range(least(n_blocks * {mixing.MAX_REPEATS}, ceil(target / block)::BIGINT + 2))) AS k FROM ts),
     ranked AS (SELECT *, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source_no, k) AS rank FROM q),
     quota AS (SELECT source_no, count(*) AS blocks FROM ranked WHERE rank <= slots GROUP BY source_no),
     b AS (SELECT ts.*, coalesce(quota.blocks, 0) AS blocks, unnest(range(n_blocks)) AS block_no
           FROM ts LEFT JOIN quota USING (source_no)),
     bl AS (SELECT *, least(block, source_size - block_no * block) AS length FROM b),
     pick AS (SELECT *, row_number() OVER o AS pick,
                  coalesce(sum(length) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
              FROM bl WINDOW o AS (PARTITION BY source_no ORDER BY
                  md5(concat_ws(':', '{mixing.SEED}', source_no::VARCHAR, block_no::VARCHAR)), block_no)),
     st AS (SELECT *, words - sum(length * (blocks // n_blocks + CASE WHEN pick <= blocks % n_blocks THEN 1 ELSE 0 END))
                  OVER (PARTITION BY source_no) AS settled, words // source_size AS times FROM pick),
     pt AS (SELECT *, greatest(0, least(length, words - times * source_size - ahead)) AS part FROM st),
     bt AS (SELECT source_no, block_no, block, times, part, blocks, settled,
                   coalesce(sum(times * length + part) OVER (PARTITION BY source_no ORDER BY block_no
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pt),
     pos AS (SELECT s.doc_id, s.size, tb.source_no, tb.source_size, tb.target, tb.block,
                    coalesce(sum(s.size) OVER (PARTITION BY tb.source_no ORDER BY s.h, s.doc_id, s.size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
             FROM sizes s JOIN tb ON s.source IS NOT DISTINCT FROM tb.source),
     ends AS (SELECT p.*, y.before + y.times * (p.a - y.block_no * y.block) + least(y.part, p.a - y.block_no * y.block) AS u,
                     z.before + z.times * (p.a + p.size - z.block_no * z.block)
                     + least(z.part, p.a + p.size - z.block_no * z.block) AS v, z.blocks, z.settled
              FROM pos p
              LEFT JOIN bt y ON y.source_no = p.source_no AND y.block_no = greatest(0, (p.a - 1) // p.block)
              LEFT JOIN bt z ON z.source_no = p.source_no AND z.block_no = greatest(0, (p.a + p.size - 1) // p.block))
SELECT doc_id, size, source_size, target, (CASE WHEN size > 0 THEN v - u ELSE 0 END)::BIGINT AS taken,
       coalesce(blocks, 0)::BIGINT AS blocks, coalesce(settled, 0)::BIGINT AS settled
FROM ends
"""

ORACLE["op10_exact_dedup"] = r"""
WITH k AS (SELECT doc_id, length(coalesce(text, '')) AS p,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM k WINDOW w AS (PARTITION BY h ORDER BY p DESC, doc_id)
"""

# The tree of the SQL has a fixed number of levels: enough for 3 ** 13 rows a source, 3 ** 8 sources.
_SOURCE_LEVELS, _TOP_LEVELS = 13, 8


def _written(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


def _tree_sql(tree: str, levels: int, walk: str) -> str:
    """CTEs: levels of ``{tree}0`` (g, idx, h), and the rows of ``{walk}0`` (rid, g, idx, proof, f) led up through them."""
    run = "PARTITION BY g, idx // 3 ORDER BY idx ROWS BETWEEN"
    parts = []
    for k in range(levels):
        parts.append(f"""
     {tree}x{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY g) AS n,
        coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {tree}{k}),
     {tree}{k + 1} AS MATERIALIZED (SELECT g, idx // 3 AS idx, CASE WHEN any_value(n) = 1 THEN any_value(h)
        ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h FROM {tree}x{k} GROUP BY g, idx // 3),
     {walk}{k + 1} AS MATERIALIZED (SELECT rid, g, w.idx // 3 AS idx, proof || l || r AS proof,
        CASE WHEN n = 1 THEN f ELSE sha256(l || f || r) END AS f FROM {walk}{k} w JOIN {tree}x{k} USING (g, idx))""")
    return ",".join(parts)


_LEAF_SQL = " || ".join(_written(c) for c in merkle.LEAF_COLUMNS)
_FLAT_SQL = " || ".join(_written(c if c != "text" else "replace(text, chr(10), '')") for c in merkle.LEAF_COLUMNS)

ORACLE["op11_merkle_manifest"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g,
                  sha256({_LEAF_SQL}) AS leaf, sha256({_FLAT_SQL}) AS flat,
                  -- the complement of the CRC-32 register after the id's digits: odd where 2 divides the CRC-32
                  list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
                              lambda x: ascii(x)::BIGINT)),
                              lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                                                       lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
           FROM documents),
     p AS MATERIALIZED (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS idx,
                               leaf AS h, rid FROM d),
     s0 AS MATERIALIZED (SELECT g, idx, h FROM p),
     w0 AS MATERIALIZED (SELECT rid, g, idx, '' AS proof, CASE WHEN crc & 1 = 1 THEN flat ELSE leaf END AS f
                         FROM d JOIN p USING (rid, g)),{_tree_sql('s', _SOURCE_LEVELS, 'w')},
     t0 AS MATERIALIZED (SELECT 0 AS g, g - 1 AS idx, h FROM s{_SOURCE_LEVELS}),
     v0 AS MATERIALIZED (SELECT rid, 0 AS g, g - 1 AS idx, proof, f FROM w{_SOURCE_LEVELS}),{_tree_sql('t', _TOP_LEVELS, 'v')}
SELECT doc_id, leaf, s{_SOURCE_LEVELS}.h AS subroot, t{_TOP_LEVELS}.h AS root, sha256(proof) AS proof_sha256,
       f AS folded_root, f = t{_TOP_LEVELS}.h AS verified
FROM d JOIN s{_SOURCE_LEVELS} USING (g) JOIN v{_TOP_LEVELS} v USING (rid) JOIN t{_TOP_LEVELS} ON t{_TOP_LEVELS}.g = 0
"""

ORACLE["op13_line_dedup"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
     one AS (SELECT rid, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM d),
     k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                               '{line_dedup.UPPER}', '{line_dedup.LOWER}') AS key FROM one),
     own AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= {line_dedup.MIN_POINTS} GROUP BY key),
     m AS (SELECT k.*, owner IS NOT NULL AND doc_id IS DISTINCT FROM owner AS gone FROM k LEFT JOIN own USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
