"""The registered query of each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnocast.llm import embedding_dups
from limnocast.llm.common import ready, table
from limnocast.llm.hard_negatives import hard_negatives
from limnocast.llm.language_id import identify
from limnocast.llm.licence_texts import FILES, NOTICES
from limnocast.llm.licenses import FILE_COSINE, LINE_COSINE, RAREST, longest_run, scan, words_of
from limnocast.llm.merkle import manifest
from limnocast.llm.nearest import nearest
from limnocast.llm.packing import pack_documents
from limnocast.llm.quality import score_quality
from limnocast.llm.secret_spans import ADDED, KINDS, find_secrets
from limnocast.llm.sentence_pieces import encode_documents
from limnocast.llm.sharding import shard
from limnocast.llm.simhash import near_duplicates
from limnocast.llm.url_filter import judge

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives the same rows where SQL can express it."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(ready(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: three-word shingles, at most three bits apart."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)


#: Vectors of usable components, in doubles.
_VECTORS = """v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"""


@query(
    "op1_embedding_dups",
    f"""WITH RECURSIVE {_VECTORS},
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
    FROM embeddings e JOIN least l ON e.vec_id = l.a LEFT JOIN counts c ON e.vec_id = c.a""",
)
def op1_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of vectors of one label with a cosine of 0.98 or more."""
    return embedding_dups.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


@query("op2_url_filter")
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's URL, by the fixed rules and by path templates."""
    return judge(table(spark, sf_dir, "pages"))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return identify(table(spark, sf_dir, "documents"))


@query(
    "op4_nearest",
    f"""WITH {_VECTORS},
    pairs AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(
        list_zip(q.e, c.e), lambda x: (x[1] - x[2]) * (x[1] - x[2])), lambda x, y: x + y)) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
    ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank, vec_id, score
      FROM pairs)
    SELECT * FROM ranked WHERE rank <= 10""",
)
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards along a Hilbert curve over language, source and size."""
    return shard(table(spark, sf_dir, "documents"), 16)


@query("op6_sentence_pieces")
def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of all documents by the 32k merge-type vocabulary, as digests."""
    model_file = public_tokenizers.path("piece_bpe_32k.model")
    return encode_documents(table(spark, sf_dir, "documents"), model_file)


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from ``labels.quality``."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def _licence_sql() -> str:
    bodies = [("told", *n) for n in NOTICES] + [("opened", *f) for f in FILES]
    values = ", ".join("('{}', {}, '{}', '{}')".format(a, i, b, c.replace("'", "''")) for i, (a, b, c) in enumerate(bodies))
    words = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"
    longest = longest_run([words_of(text) for _, text in NOTICES], LINE_COSINE)
    rare = f"ln({RAREST}.0::DOUBLE)"
    return f"""WITH template(side, template, licence, body) AS (VALUES {values}),
    docs AS (SELECT row_number() OVER () AS r, doc_id, concat_ws('/', source, lang, doc_id::VARCHAR) AS path, text FROM documents),
    held AS (SELECT *, regexp_replace(path, '/?[^/]*$', '') AS dir FROM docs),
    counts AS (SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct({words.format("text")})) AS term FROM held) GROUP BY term),
    total AS (SELECT count(*) AS n FROM documents),
    idf AS (SELECT term, 1 + least(ln((1 + (SELECT n FROM total)) / (1 + n)::DOUBLE), {rare}) / {rare} AS idf FROM counts),
    unheld AS (SELECT 1 + least(ln(1 + (SELECT n FROM total)::DOUBLE), {rare}) / {rare} AS idf),
    entry AS (SELECT side, template, licence, term, (1 + ln(count(*))) * coalesce(any_value(idf.idf), (SELECT idf FROM unheld)) AS value
      FROM (SELECT side, template, licence, unnest({words.format("body")}) AS term FROM template) LEFT JOIN idf USING (term) GROUP BY ALL),
    lengths AS (SELECT side, template, sqrt(sum(value * value)) AS length FROM entry GROUP BY ALL),
    sizes AS (SELECT template, len({words.format("body")}) AS size FROM template WHERE side = 'opened'),
    cut AS (SELECT r, unnest(list_filter(list_transform(string_split(text, chr(10)), lambda l: {words.format("l")}), lambda w: len(w) > 0)) AS words,
      generate_subscripts(list_filter(list_transform(string_split(text, chr(10)), lambda l: {words.format("l")}), lambda w: len(w) > 0), 1) AS i FROM held),
    line AS (SELECT r, i, words, sum(len(words)) OVER (PARTITION BY r ORDER BY i) AS upto,
      len(list_intersect(words, (SELECT list(DISTINCT term) FROM entry WHERE side = 'told'))) > 0 AS known FROM cut),
    runs AS (SELECT a.r, a.i AS first, b.i AS last FROM line a JOIN line b ON a.r = b.r AND a.known AND b.known AND b.i >= a.i AND b.i <= a.i + {longest}
      AND (a.i = b.i OR b.upto - a.upto + len(a.words) <= {longest})),
    units AS (SELECT r, 'run' AS kind, NULL AS template, first, last, (SELECT flatten(list(l.words ORDER BY l.i)) FROM line l
        WHERE l.r = runs.r AND l.i BETWEEN first AND last) AS words FROM runs
      UNION ALL SELECT r, 'start', template, 0, 0, list_slice({words.format("text")}, 1, size) FROM held, sizes WHERE len({words.format("text")}) > 0
      UNION ALL SELECT r, 'whole', NULL, 0, 0, {words.format("text")} FROM held WHERE len({words.format("text")}) > 0),
    numbered AS (SELECT row_number() OVER () AS u, * FROM units),
    own AS (SELECT u, term, (1 + ln(count(*))) * any_value(idf.idf) AS own FROM (SELECT u, unnest(words) AS term FROM numbered) JOIN idf USING (term) GROUP BY u, term),
    squares AS (SELECT u, sum(own * own) AS square FROM own GROUP BY u),
    cosines AS (SELECT u, side, template, licence, round(dot / (length * sqrt(square)), 9) AS cosine
      FROM (SELECT u, side, template, licence, sum(own * value) AS dot FROM own JOIN entry USING (term) GROUP BY ALL)
      JOIN lengths USING (side, template) JOIN squares USING (u)),
    noticed AS (SELECT r, first, last, licence, cosine FROM cosines JOIN numbered n USING (u)
      WHERE n.kind = 'run' AND side = 'told' AND cosine >= {LINE_COSINE}),
    covered AS (SELECT *, unnest(generate_series(first, last)) AS i FROM noticed),
    per_line AS (SELECT * FROM covered QUALIFY row_number() OVER (PARTITION BY r, i ORDER BY cosine DESC, last - first, first, licence) = 1),
    spoken AS (SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices FROM per_line GROUP BY r),
    notice AS (SELECT r, licence, cosine FROM per_line QUALIFY row_number() OVER (PARTITION BY r ORDER BY cosine DESC, licence) = 1),
    whole AS (SELECT r, c.template FROM cosines c JOIN numbered n USING (u) WHERE n.kind = 'whole' AND side = 'opened' AND cosine >= {FILE_COSINE}),
    filed AS (SELECT n.r, licence, cosine FROM cosines c JOIN numbered n USING (u) JOIN whole w ON w.r = n.r AND w.template = c.template
      WHERE n.kind = 'start' AND side = 'opened' AND c.template = n.template AND cosine >= {LINE_COSINE}
      QUALIFY row_number() OVER (PARTITION BY n.r ORDER BY cosine DESC, licence) = 1),
    spoken_for AS (SELECT dir, licence FROM (SELECT dir, licence, count(*) AS n FROM filed JOIN held USING (r) GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY dir ORDER BY n DESC, licence) = 1),
    heirs AS (SELECT d.dir, s.dir AS from_dir, s.licence FROM (SELECT DISTINCT dir FROM held) d JOIN spoken_for s
      ON s.dir = '' OR d.dir = s.dir OR starts_with(d.dir, s.dir || '/')
      QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(s.dir) DESC) = 1)
    SELECT h.doc_id, h.path, coalesce(f.licence, n.licence, i.licence) AS license,
      CASE WHEN f.r IS NOT NULL THEN 'file' WHEN n.r IS NOT NULL THEN 'notice' WHEN i.licence IS NOT NULL THEN 'inherited' END AS basis,
      coalesce(f.cosine, n.cosine) AS cosine, coalesce(s.notices, '') AS notices,
      CASE WHEN f.r IS NULL AND n.r IS NULL THEN i.from_dir END AS from_dir
    FROM held h LEFT JOIN filed f USING (r) LEFT JOIN notice n USING (r) LEFT JOIN spoken s USING (r) LEFT JOIN heirs i ON h.dir = i.dir"""


@query("op10_licenses", _licence_sql())
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document by its notices or its directory, ``source/lang``."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return scan(table(spark, sf_dir, "documents"), path)


@query("op11_secrets")
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of all documents: the spans of the patterns, and those that the random field adds."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    told = "transform({}, x -> concat_ws(':', x.kind, string(x.start), string(x.end)))"
    base = f"filter(secrets, x -> x.kind <> '{ADDED}')"
    return found.select(
        "doc_id",
        *(F.expr(f"bigint(size(filter(secrets, x -> x.kind = '{kind}')))").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.expr(f"array_join({told.format(base)}, ',')"), 256).alias("base_sha256"),
        F.expr(f"array_join({told.format('secrets')}, ',')").alias("spans"),
    )


_ROWS = """WITH v AS (SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


@query(
    "op13_hard_negatives",
    f"""{_ROWS},
    scored AS (SELECT a.r, a.vec_id AS anchor_id, a.label = c.label AS alike, c.vec_id,
        list_sum(list_transform(list_zip(a.e, c.e), lambda x: x[1] * x[2]))::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.r <> c.r AND len(a.e) = len(c.e)),
    positives AS (SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
      QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5),
    numbered AS (SELECT *, row_number() OVER () AS p FROM positives),
    ranked AS (SELECT p.anchor_id, p.positive_id,
        row_number() OVER (PARTITION BY p.p ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
        n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
      FROM numbered p JOIN scored n ON p.r = n.r AND NOT n.alike
        AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score)
    SELECT * FROM ranked WHERE rank <= 10""",
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, a seventh of the labels moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def _manifest_sql() -> str:
    def told(value: str) -> str:
        text = f"({value})::VARCHAR"
        return f"CASE WHEN {text} IS NULL THEN '-' ELSE strlen({text})::VARCHAR || ':' || {text} END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(told(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    # The checksum's lowest bit, before its final inversion.
    codes = "[4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
    step = "CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384::BIGINT) ELSE u >> 1 END"
    crc = f"list_reduce({codes}, lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda u, z: {step}))"
    grow = """SELECT lvl + 1, g, i // 3, sha256(string_agg(node, '' ORDER BY i)), (n + 2) // 3 FROM {0}
      WHERE n > 1 GROUP BY lvl, g, i // 3, n"""
    return f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce('+' || source, '') AS g, {leaf("text")} AS leaf,
      CASE WHEN {crc} & 1 = 1 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS bad FROM documents),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
    tree AS (SELECT 0 AS lvl, g, i, leaf AS node, n FROM leaves UNION ALL {grow.format("tree")}),
    subroots AS (SELECT g, node, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
    top AS (SELECT 0 AS lvl, '' AS g, i, node, n FROM subroots UNION ALL {grow.format("top")}),
    runs AS (SELECT l.r, t.lvl, t.i, l.i // (3 ** t.lvl)::BIGINT AS own, t.node FROM leaves l JOIN tree t
        ON l.g = t.g AND t.n > 1 AND t.i // 3 = l.i // (3 ** (t.lvl + 1))::BIGINT
      UNION ALL SELECT l.r, 1000 + t.lvl, t.i, s.i // (3 ** t.lvl)::BIGINT, t.node FROM leaves l JOIN subroots s ON l.g = s.g JOIN top t
        ON t.n > 1 AND t.i // 3 = s.i // (3 ** (t.lvl + 1))::BIGINT),
    steps AS (SELECT r, lvl, coalesce(string_agg(node, '' ORDER BY i) FILTER (i < own), '') AS a,
      coalesce(string_agg(node, '' ORDER BY i) FILTER (i > own), '') AS b FROM runs GROUP BY r, lvl),
    paths AS (SELECT r, string_agg(a || b, '' ORDER BY lvl) AS sides, list(a || '|' || b ORDER BY lvl) AS each FROM steps GROUP BY r),
    told AS (SELECT l.*, coalesce(p.sides, '') AS sides, list_reduce([l.bad] || coalesce(p.each, []), lambda x, y:
      sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2))) AS folded_root FROM leaves l LEFT JOIN paths p USING (r))
    SELECT t.doc_id, t.leaf, s.node AS subroot, (SELECT node FROM top WHERE n = 1) AS root, sha256(t.sides) AS proof_sha256, t.folded_root,
      t.folded_root = (SELECT node FROM top WHERE n = 1) AS verified, t.source, t.i AS place FROM told t JOIN subroots s USING (g)"""


@query("op12_manifest", _manifest_sql())
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of all documents by source; half of the ids have lost their line ends since."""
    struck = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = {"text": F.when(struck, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    return manifest(table(spark, sf_dir, "documents"), changed=changed)
