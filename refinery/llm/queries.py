"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm.common import ascii_lower, table
from refinery.llm.decontaminate import contamination
from refinery.llm.exact_dedup import refine
from refinery.llm.html_main import extract, learn
from refinery.llm.jaccard_join import similar_groups
from refinery.llm.language import held_out, identify, train_on_open_part
from refinery.llm.line_dedup import apply_bitmaps, keep_bitmaps
from refinery.llm.merkle import folded, leaf_hash, manifest, proof_digest
from refinery.llm.mixing import mix
from refinery.llm.periodic_runs import collapse_runs
from refinery.llm.sharding import pack
from refinery.llm.suffix_dedup import remove_repeats
from refinery.llm.tokens import read_token_files, write_token_files
from refinery.llm.warc import round_trip
from refinery.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    out = contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_warc_salvage(spark: SparkSession, sf: str) -> DataFrame:
    back = round_trip(table(spark, sf, "pages"))
    return back.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))


def op3_vector_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = pack(table(spark, sf, "documents"), shards=40, overhead=16)
    return packed.select(F.col("id").alias("doc_id"), F.col("bytes").alias("size"), F.col("crc32").alias("text_crc32"),
                         F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))


def op4_water_filling(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mix(table(spark, sf, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("times") * F.col("size")).cast("long").alias("taken"))


def op5_seekable_tokens(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    manifest = write_token_files(table(spark, sf, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_progressive_refinement(spark: SparkSession, sf: str) -> DataFrame:
    out = refine(table(spark, sf, "documents"), digest_all=True)
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op7_prefix_doubling(spark: SparkSession, sf: str) -> DataFrame:
    out = remove_repeats(table(spark, sf, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      "kept_sha256")


def op8_maximum_subsequence(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return extract(pages, learn(pages))


def op9_set_relation_skipping(spark: SparkSession, sf: str) -> DataFrame:
    groups = similar_groups(table(spark, sf, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op10_hierarchical_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return identify(docs, train_on_open_part(docs), carry={"doc_id": F.col("doc_id"), "held_out": held_out()})


def op11_range_partitioned_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    out = apply_bitmaps(docs, keep_bitmaps(docs))
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_bitmap_rank_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = leaf_hash(*[F.col(c) for c in columns[:-1]], ascii_lower(F.col("text")))
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    out = manifest(docs, "doc_id", "source", leaf_hash(*[F.col(c) for c in columns]), F.when(chosen, tampered))
    out = out.withColumn("folded_root", folded(F.coalesce("altered", "leaf")))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_maximal_pairs(spark: SparkSession, sf: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string"))
    out = collapse_runs(table(spark, sf, "documents"), loop_seed=F.when(h % 10 == 0, F.floor(h / 10)))
    runs = F.col("runs")
    # the greatest length / period, compared exactly; the first of equals in order of start and period
    best = F.reduce(runs, F.get(runs, F.lit(0)), lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    out = out.withColumn("best", best)
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.select("doc_id", F.size(runs).cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                      F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                      F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Query] = {
    "op1_winnowing": op1_winnowing,
    "op2_warc_salvage": op2_warc_salvage,
    "op3_vector_packing": op3_vector_packing,
    "op4_water_filling": op4_water_filling,
    "op5_seekable_tokens": op5_seekable_tokens,
    "op6_progressive_refinement": op6_progressive_refinement,
    "op7_prefix_doubling": op7_prefix_doubling,
    "op8_maximum_subsequence": op8_maximum_subsequence,
    "op9_set_relation_skipping": op9_set_relation_skipping,
    "op10_hierarchical_language": op10_hierarchical_language,
    "op11_range_partitioned_lines": op11_range_partitioned_lines,
    "op12_bitmap_rank_manifest": op12_bitmap_rank_manifest,
    "op13_maximal_pairs": op13_maximal_pairs,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SPACED = f"regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+')"

_KEY = "trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')"


def _encoded(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def manifest_statement(row_levels: int = 6, group_levels: int = 3) -> str:
    """The Merkle manifest as SQL, for up to 16**row_levels rows of a source and
    16**group_levels sources; a level hands a single node on."""
    fields = " || ".join(_encoded(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # CRC-32 of the digits, by the usual table of 256 remainders
    entry = "list_reduce(list_prepend(i, range(8)), lambda c, b: xor(c >> 1, 3988292384 * (c & 1)))"
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), "
           "lambda d: CAST(ascii(d) AS BIGINT))), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])))")
    parts = [f"crc AS (SELECT list({entry} ORDER BY i) AS crc_table FROM (SELECT unnest(range(256)) AS i))",
             f"leaves AS (SELECT doc_id, source, sha256({fields} || {_encoded('text')}) AS h, "
             f"CASE WHEN {crc} % 5 = 0 THEN sha256({fields} || {_encoded(lowered)}) END AS altered, "
             "row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS p FROM documents, crc)",
             "r0 AS (SELECT source AS g, p, h FROM leaves)"]

    def levels(name: str, count: int) -> None:
        run = "PARTITION BY g, p // 16 ORDER BY p ROWS BETWEEN"
        for k in range(count):
            parts.append(f"{name}s{k} AS (SELECT *, count(*) OVER (PARTITION BY g) > 1 AS many, "
                         f"coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                         f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})")
            parts.append(f"{name}{k + 1} AS (SELECT g, p // 16 AS p, CASE WHEN any_value(many) THEN sha256(string_agg(h, '' ORDER BY p)) "
                         f"ELSE any_value(h) END AS h FROM {name}s{k} GROUP BY g, p // 16)")

    levels("r", row_levels)
    parts.append(f"g0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS p, h, g AS source FROM r{row_levels})")
    levels("g", group_levels)
    joins = [f"JOIN rs{k} ON rs{k}.g IS NOT DISTINCT FROM source AND rs{k}.p = leaves.p // {16 ** k}" for k in range(row_levels)]
    joins.append("JOIN g0 ON g0.source IS NOT DISTINCT FROM leaves.source")
    joins += [f"JOIN gs{k} ON gs{k}.p = g0.p // {16 ** k}" for k in range(group_levels)]
    steps = [f"rs{k}" for k in range(row_levels)] + [f"gs{k}" for k in range(group_levels)]
    proof = " || ".join(f"CASE WHEN {s}.many THEN {s}.l || {s}.r ELSE '' END" for s in steps)
    sides = ", ".join(f"{s}.many AS {s}m, {s}.l AS {s}l, {s}.r AS {s}r" for s in steps)
    parts.append(f"paths AS (SELECT doc_id, leaves.h AS leaf, g0.h AS subroot, sha256({proof}) AS proof_sha256, "
                 f"coalesce(altered, leaves.h) AS f, {sides} FROM leaves {' '.join(j.replace(' source ', ' leaves.source ') for j in joins)})")
    last = "paths"
    for s in steps:
        parts.append(f"f{s} AS (SELECT * REPLACE (CASE WHEN {s}m THEN sha256({s}l || f || {s}r) ELSE f END AS f) FROM {last})")
        last = f"f{s}"
    return (f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified "
            f"FROM {last}, (SELECT h AS root FROM g{group_levels})")


ORACLE: dict[str, str] = {
    "op11_range_partitioned_lines": f"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
  keys AS (SELECT doc_id, pos, line, translate({_KEY}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
  shared AS (SELECT key, max(doc_id) AS last FROM keys WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE last <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE last IS NULL OR last = doc_id), '')) AS kept_sha256
FROM keys LEFT JOIN shared USING (key) GROUP BY doc_id
""",
    "op12_bitmap_rank_manifest": manifest_statement(),
    "op1_winnowing": f"""
WITH docs AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
  items AS (SELECT item_id, w, least(len(w), 10) AS k FROM (SELECT item_id, {_ALNUM} AS w FROM benchmark) WHERE len(w) > 0),
  windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
  grams AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows))),
  hits AS (SELECT doc_id, i, k, item_id FROM grams JOIN windows USING (k, g)),
  words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY ALL),
  found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY ALL)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op9_set_relation_skipping": f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_SPACED} AS w FROM documents),
  sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY ALL),
  common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
  links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
  reached AS (SELECT doc_id, doc_id AS r FROM docs UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.r)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
""",
    "op6_progressive_refinement": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
}
