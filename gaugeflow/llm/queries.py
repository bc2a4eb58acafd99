"""The registered queries of the operators, and the SQL that states their results where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import (
    contamination,
    embedding_dedup,
    html_text,
    licenses,
    merkle,
    mixing,
    neighbours,
    pieces,
    simhash,
    spelling,
    substring,
    toxicity,
    url_filter,
)


@dataclass(frozen=True)
class Query:
    plan: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: the source is the top directory, the language the next."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licenses.scan(table(spark, sf_dir, "documents"), "doc_id", path)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of a segmentation as a digest; the operator returns them as they are."""
    got = pieces.sample(table(spark, sf_dir, "documents"))
    return got.select(
        "doc_id", "sample", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_digest"),
        "log_probability", "perturbed", "log_inclusion", "round_trip",
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = html_text.main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return got.withColumn("n_chars", F.length("text").cast("bigint"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values at their fixed point; the SQL does the default number of rounds."""
    got = url_filter.judge(table(spark, sf_dir, "pages"), settings=url_filter.Settings(tolerance=1e-9))
    return got.select("page_id", "host", "path", "rule", "verdict")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), damage=199)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree a source; rows of even checksum are verified as received without their line ends."""
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    shown = [*values[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), "doc_id", "source", values, shown, changed)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of a text as a digest; the operator returns them, and the passages, as they are."""
    got = contamination.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    ids = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return got.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x != ''] AS ws
           FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
s AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS pos FROM d WHERE len(ws) >= 20),
k AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY array_to_string(ws[pos:pos + 19], ' ') ORDER BY doc_id, pos) > 1 AS again
      FROM s),
c AS (SELECT w.doc_id, w.word, w.pos,
             coalesce(bool_or(again) OVER (PARTITION BY w.doc_id ORDER BY w.pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), FALSE) AS gone
      FROM w LEFT JOIN k ON k.doc_id = w.doc_id AND k.pos = w.pos),
g AS (SELECT doc_id, count(*) AS n_words, sum(gone::INT) AS n_removed,
             coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""

EMBEDDINGS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
f AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN e IF x != 0]) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM f AS a JOIN f AS b ON a.label = b.label AND a.vec_id != b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.id),
c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON v.vec_id = c.id LEFT JOIN n ON v.vec_id = n.a
"""


def _licenses_sql() -> str:
    """All lines against all templates, without the prefilter."""
    s = licenses.Settings()
    rows = [(i, license_, t, n) for i, ((license_, _), c) in enumerate(zip(licenses.TEMPLATES, licenses.counts(), strict=True)) for t, n in c.items()]
    values = ", ".join(f"({i}, '{name}', '{t}', {n})" for i, name, t, n in rows)
    return rf"""
WITH c(template, license, term, k) AS (VALUES {values}),
d AS (SELECT doc_id, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path, concat_ws('/', source, lang) AS dir,
             coalesce(text, '') AS text FROM documents),
n AS (SELECT count(*) AS n FROM d),
df AS (SELECT term, count(*) AS df FROM (
         SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM d) AS x
       WHERE term IN (SELECT term FROM c) GROUP BY term),
w AS (SELECT c.term, ln((1.0 + n) / (1.0 + coalesce(max(df), 0))) + 1.0 AS idf FROM c LEFT JOIN df ON c.term = df.term, n GROUP BY c.term, n),
t AS (SELECT template, license, c.term, k * idf / sqrt(sum((k * idf) ** 2) OVER (PARTITION BY template)) AS t FROM c JOIN w ON c.term = w.term),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln_ FROM d),
z AS (SELECT doc_id, ln_, len([x FOR x IN string_split_regex(line, '[\x20\x09-\x0D]+') IF x != '']) AS words,
             unnest(regexp_extract_all(lower(line), '[a-z0-9]+')) AS term FROM l),
f AS (SELECT doc_id, ln_, words, z.term, count(*) * coalesce(max(idf), (SELECT ln((1.0 + n) / 2.0) + 1.0 FROM n)) AS w
      FROM z LEFT JOIN w ON z.term = w.term GROUP BY doc_id, ln_, words, z.term),
g AS (SELECT doc_id, ln_, sqrt(sum(w * w)) AS size FROM f GROUP BY doc_id, ln_),
s AS (SELECT f.doc_id, f.ln_, words, template, license, round(sum(w * t) / any_value(size), {s.digits}) AS score
      FROM f JOIN t ON f.term = t.term JOIN g ON f.doc_id = g.doc_id AND f.ln_ = g.ln_ GROUP BY f.doc_id, f.ln_, words, template, license),
b AS (SELECT doc_id, ln_, words, max(struct_pack(score := score, license := license)) AS best FROM s WHERE score >= {s.least} GROUP BY doc_id, ln_, words),
o AS (SELECT doc_id, max(best) AS best, sum(words) AS in_lines FROM b GROUP BY doc_id),
q AS (SELECT d.*, best, in_lines, len([x FOR x IN string_split_regex(text, '[\x20\x09-\x0D]+') IF x != '']) AS n_words
      FROM d LEFT JOIN o ON d.doc_id = o.doc_id),
u AS (SELECT dir, best FROM (SELECT dir, best, row_number() OVER (PARTITION BY dir ORDER BY best.score DESC, path) AS p FROM q
      WHERE in_lines >= {s.share} * n_words) AS x WHERE p = 1),
a AS (SELECT q.doc_id, u.dir AS up, u.best, row_number() OVER (PARTITION BY q.doc_id ORDER BY length(u.dir) DESC) AS p
      FROM q JOIN u ON q.dir = u.dir OR starts_with(q.dir, u.dir || '/') OR u.dir = '')
SELECT q.doc_id, q.path, coalesce(q.best.license, a.best.license) AS license, coalesce(q.best.score, a.best.score) AS score,
       CASE WHEN q.best IS NOT NULL THEN q.path ELSE a.up END AS origin
FROM q LEFT JOIN a ON q.doc_id = a.doc_id AND a.p = 1
"""


LICENSES_SQL = _licenses_sql()


def _urls_sql() -> str:
    """Rules as a longest match; values by the same rounds, one after the other."""
    s = url_filter.Settings()
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.text}', '{r.verdict}')" for r in url_filter.RULES)
    part = lambda url, what: (
        f"CASE WHEN instr({url}, '://') > 0 THEN regexp_extract(substr({url}, instr({url}, '://') + 3), {what}) ELSE '' END"
    )
    host = lambda url: f"coalesce(translate({part(url, chr(39) + '^[^/?#]*' + chr(39))}, '{url_filter.UPPER}', '{url_filter.LOWER}'), '')"
    where = "'(?s)^[^/?#]*([^?#]*)', 1"
    link = url_filter.LINK.replace("'", "''")
    rounds = "v0 AS (SELECT host, trust, distrust FROM seed)"
    for i in range(s.rounds):
        rounds += f""",
v{i + 1} AS (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
  SELECT b AS host, trust * t * {s.damping} AS trust, distrust * d * {s.damping} AS distrust FROM v{i} JOIN moves ON a = host
  UNION ALL SELECT host, trust * (1 - {s.damping}), distrust * (1 - {s.damping}) FROM seed) AS x GROUP BY host)"""
    return f"""
WITH r(host, path, rule, verdict) AS (VALUES {rules}),
p AS (SELECT page_id, {host("url")} AS host, coalesce({part("url", where)}, '') AS path, html FROM pages),
m AS (SELECT p.page_id, p.host, p.path, max_by(r.rule, length(r.rule)) AS rule, max_by(r.verdict, length(r.rule)) AS verdict
      FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
      GROUP BY p.page_id, p.host, p.path),
n AS (SELECT host, count(*) FILTER (WHERE verdict = 'allow') AS allowed, count(*) FILTER (WHERE verdict = 'block') AS blocked
      FROM m WHERE verdict IS NOT NULL GROUP BY host),
seed AS (SELECT host, allowed / greatest(sum(allowed) OVER (), 1) AS trust, blocked / greatest(sum(blocked) OVER (), 1) AS distrust FROM n),
l AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)) AS link FROM p),
h AS (SELECT src, {host("(CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END)")} AS dst FROM l),
e AS (SELECT src, dst, count(*) AS n FROM h WHERE src != dst AND src != '' AND dst != '' GROUP BY src, dst),
moves AS (SELECT src AS a, dst AS b, n / sum(n) OVER (PARTITION BY src) AS t, 0.0 AS d FROM e
          UNION ALL SELECT dst, src, 0.0, n / sum(n) OVER (PARTITION BY dst) FROM e),
{rounds}
SELECT m.page_id, m.host, m.path, m.rule,
       coalesce(m.verdict, CASE WHEN v.distrust > {s.threshold} * (v.trust + v.distrust) THEN 'block' ELSE 'allow' END) AS verdict
FROM m LEFT JOIN v{s.rounds} AS v ON m.host = v.host
"""


URLS_SQL = _urls_sql()


def _crc32_sql(text: str) -> str:
    """The unsigned crc32 of a text, bit by bit, the lowest bit of a byte first."""
    code = f"hex(encode({text}))"
    bits = f"flatten([[(CAST('0x' || substr({code}, 2 * i + 1, 2) AS BIGINT) >> j) & 1 FOR j IN range(8)] FOR i IN range(length({code}) // 2)])"
    step = "xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce({bits}, lambda c, b: {step}, 4294967295), 4294967295)"


SPELLING_SQL = rf"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
r AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, translate(run, '{spelling.UPPER}', '{spelling.LOWER}') AS run FROM t) AS x
      WHERE length(run) >= 6 GROUP BY doc_id, run),
h AS (SELECT run, n, {_crc32_sql("CAST(doc_id AS VARCHAR) || ':' || run")} AS h FROM r),
c AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM c WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
k AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v) AS x),
p AS (SELECT a.word AS a, b.word AS b, b.n FROM k AS a JOIN k AS b ON a.cut = b.cut AND a.i = b.i AND a.word != b.word
      UNION SELECT k.word, v.word, v.n FROM k JOIN v ON k.cut = v.word
      UNION SELECT v.word, k.word, k.n FROM k JOIN v ON k.cut = v.word),
q AS (SELECT a, b, n, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS place, count(*) OVER (PARTITION BY a) AS n_near FROM p),
f AS (SELECT word, v.n, coalesce(q.n_near, 0) AS n_near, CASE WHEN q.n >= 5 * v.n THEN q.b END AS form, CASE WHEN q.n >= 5 * v.n THEN q.n END AS form_n
      FROM v LEFT JOIN q ON q.a = v.word AND q.place = 1),
w(word, here, depth) AS (SELECT word, word, 0 FROM f UNION ALL SELECT w.word, f.form, depth + 1 FROM w JOIN f ON w.here = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, max_by(w.here, w.depth) AS root, f.n, f.n_near, f.form_n FROM f JOIN w ON f.word = w.word GROUP BY ALL
""".replace("WITH t AS", "WITH RECURSIVE t AS")


def _merkle_sql() -> str:
    field = lambda c: f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    def tree(nodes: str, first: str) -> str:
        """Nodes of all levels, and what stands beside each of them."""
        return f"""
{nodes}(tree, level, place, n, digest) AS ({first} UNION ALL
  SELECT tree, level + 1, place // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY place)) FROM {nodes} WHERE n > 1
  GROUP BY tree, level, place // 3),
{nodes}_beside AS (SELECT a.tree, a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS r
  FROM {nodes} AS a JOIN {nodes} AS b ON a.tree = b.tree AND a.level = b.level AND a.place // 3 = b.place // 3 AND a.n > 1 GROUP BY a.tree, a.level, a.place),
{nodes}_top AS (SELECT tree, digest FROM {nodes} WHERE n = 1)"""

    return f"""
WITH RECURSIVE d AS (SELECT doc_id, source, {leaf("text")} AS leaf, CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0
       THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS shown FROM documents),
s AS (SELECT source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, count(*) AS n FROM d GROUP BY source),
x AS (SELECT d.*, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS place
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
{tree("low", "SELECT tree, 0, place, n, leaf FROM x")},
{tree("high", "SELECT 0, 0, s.tree, (SELECT count(*) FROM s), t.digest FROM s JOIN low_top AS t ON s.tree = t.tree")},
climb(tree, leaf_no, level, place, proof, fold) AS (SELECT tree, place, 0, place, '', shown FROM x UNION ALL
  SELECT c.tree, c.leaf_no, c.level + 1, c.place // 3, proof || l || r, sha256(l || fold || r)
  FROM climb AS c JOIN low_beside AS b ON b.tree = c.tree AND b.level = c.level AND b.place = c.place),
up(tree, leaf_no, level, place, proof, fold) AS (
  SELECT c.tree, c.leaf_no, 0, c.tree, proof, fold FROM climb AS c JOIN low AS t ON t.tree = c.tree AND t.level = c.level AND t.place = c.place AND t.n = 1 UNION ALL
  SELECT c.tree, c.leaf_no, c.level + 1, c.place // 3, proof || l || r, sha256(l || fold || r)
  FROM up AS c JOIN high_beside AS b ON b.level = c.level AND b.place = c.place)
SELECT x.doc_id, x.leaf, t.digest AS subroot, r.digest AS root, sha256(u.proof) AS proof_sha256, u.fold AS folded_root, u.fold = r.digest AS verified
FROM x JOIN low_top AS t ON t.tree = x.tree JOIN high AS r ON r.n = 1
JOIN up AS u ON u.tree = x.tree AND u.leaf_no = x.place AND u.level = r.level
"""


MERKLE_SQL = _merkle_sql()

CONTAMINATION_SQL = rf"""
WITH n(kind, id, ws) AS (
  SELECT kind, id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), '{spelling.UPPER}', '{spelling.LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x != '']
  FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark) AS x),
b AS (SELECT DISTINCT id, least(len(ws), 10) AS k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
      FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM n WHERE kind = 'b' AND len(ws) > 0) AS x),
l AS (SELECT DISTINCT k FROM b),
w AS (SELECT id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS win
      FROM (SELECT n.id, n.ws, l.k, unnest(range(1, len(n.ws) - l.k + 2)) AS i FROM n, l WHERE n.kind = 'd' AND len(n.ws) >= l.k) AS x),
m AS (SELECT w.id, w.i, w.k, b.id AS item FROM w JOIN b ON w.k = b.k AND w.win = b.win),
h AS (SELECT id, count(DISTINCT j) AS n_hit FROM (SELECT id, unnest(range(i, i + k)) AS j FROM m) AS x GROUP BY id),
g AS (SELECT id, count(*) AS n_items, string_agg(CAST(item AS VARCHAR), ',' ORDER BY CAST(item AS VARCHAR)) AS items
      FROM (SELECT DISTINCT id, item FROM m WHERE item IS NOT NULL) AS x GROUP BY id)
SELECT n.id AS doc_id, CAST(len(n.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM n LEFT JOIN h ON h.id = n.id LEFT JOIN g ON g.id = n.id WHERE n.kind = 'd'
"""

QUERIES: dict[str, Query] = {
    "op1_licenses": Query(op1_licenses, LICENSES_SQL),
    "op2_simhash": Query(op2_simhash),
    "op3_mixing": Query(op3_mixing),
    "op4_embedding_dedup": Query(op4_embedding_dedup, EMBEDDINGS_SQL),
    "op5_substring": Query(op5_substring, SUBSTRING_SQL),
    "op6_sentencepiece": Query(op6_sentencepiece),
    "op7_html": Query(op7_html),
    "op8_neighbours": Query(op8_neighbours),
    "op9_urls": Query(op9_urls, URLS_SQL),
    "op10_toxicity": Query(op10_toxicity),
    "op11_spelling": Query(op11_spelling, SPELLING_SQL),
    "op12_merkle": Query(op12_merkle, MERKLE_SQL),
    "op13_decontamination": Query(op13_decontamination, CONTAMINATION_SQL),
}
