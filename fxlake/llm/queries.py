"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fxlake.llm import decontaminate, jaccard, licences, lines, lm, manifest, periods, pieces, pii, quality, secrets, topk, urls


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(_read(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base", 256).alias("base_sha256"), "spans")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        decontaminate.contaminated().alias("contaminated"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_read(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_read(spark, sf_dir, "pages")).drop("by")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    judged = quality.judge(documents, quality.fit(documents, _read(spark, sf_dir, "labels")))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.join(_read(spark, sf_dir, "documents"), words=4, percent=85)
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every text, their digest, and whether decoding gives the text back."""
    return pieces.round_trip(_read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.apply_bitmaps(documents, lines.keep_bitmaps(documents))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(_read(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "whole_text", "n_lines", "licences")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    found = secrets.scan(documents, model=secrets.train(documents))
    return found.select(F.col("doc").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text after the planted repeats, and the digest of the text without them."""
    found = periods.find_runs(periods.plant_repeats(_read(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    text = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.withColumn("best", periods.strongest(F.col("runs")))
    return best.select("row.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(text, 256).alias("runs_sha256"),
                       F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proof for every leaf, and the root that it gives with the row as it is now: a third of the texts were lower-cased."""
    documents = _read(spark, sf_dir, "documents")
    tampered = [F.translate("text", _AZ, _AZ.lower()) if c == "text" else F.col(c) for c in manifest.FIELDS]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tree = manifest.build(documents, keep={"tampered": F.when(changed, manifest.leaf_digest(tampered))})
    folded = manifest.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return (manifest.prove(tree).withColumn("folded_root", folded)
            .select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.array_join(manifest.siblings(F.col("path")), ""), 256).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _read(spark, sf_dir, "embeddings")
    return topk.search(embeddings, embeddings.where(F.col("vec_id") % 50 == 0))


_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS g
       FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hits AS (SELECT doc_id, n, k, item_id FROM dw JOIN iw USING (n, g)),
pos AS (SELECT doc_id, count(*) AS n_hit FROM
        (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, n, k FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low.m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = d.doc_id
"""

OP8_SQL = r"""
WITH l AS (SELECT doc_id, k, parts[k] AS line,
                  translate(regexp_replace(regexp_replace(parts[k], '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
           FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS k
                 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
f AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, f.key IS NOT NULL AND l.doc_id < f.keeper AS lost FROM l LEFT JOIN f ON l.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

def _canonical_sql(x: str) -> str:
    out = f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = rf"regexp_replace({out}, '(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*', '\1', 'g')"
    out = rf"regexp_replace({out}, '[^a-z0-9\x{{80}}-\x{{10ffff}}]+', ' ', 'g')"
    out = f"' ' || trim({out}) || ' '"
    for old, new in licences.SPELLINGS:
        if old != new:
            out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"sha256({out})"


def _licence_sql() -> str:
    rows = ", ".join("('%s', '%s')" % (name, text.replace("'", "''")) for name, texts in licences.KNOWN.items() for text in texts)
    return f"""
WITH known AS (SELECT DISTINCT {_canonical_sql('t')} AS digest, licence FROM (VALUES {rows}) v(licence, t)),
whole AS (SELECT doc_id, licence FROM documents JOIN known ON {_canonical_sql("coalesce(text, '')")} = digest),
line AS (SELECT doc_id, licence FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x FROM documents)
         JOIN known ON {_canonical_sql('x')} = digest),
n AS (SELECT doc_id, count(*) AS n_lines FROM line GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS licences
      FROM (SELECT DISTINCT doc_id, licence FROM (SELECT * FROM line UNION ALL SELECT * FROM whole)) GROUP BY doc_id)
SELECT d.doc_id, whole.licence AS whole_text, CAST(coalesce(n.n_lines, 0) AS BIGINT) AS n_lines, coalesce(l.licences, '') AS licences
FROM documents d LEFT JOIN whole USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN l USING (doc_id)
"""


def _rule_sql(host: str, path: str, want: int) -> str:
    """The rule (want 1) or its verdict (want 0), longest first."""
    cases = []
    for verdict, rule in sorted(urls.RULES, key=lambda r: (-len(r[1]), r[0] == "block")):
        name, _, rest = rule.partition("/")
        cases.append(f"WHEN ({host} = '{name}' OR ends_with({host}, '.{name}')) AND starts_with({path}, '/{rest}') "
                     f"THEN '{(verdict, rule)[want]}'")
    return f"CASE {' '.join(cases)} END"


def _clear_sql(path: str) -> str:
    """``path`` without dot segments."""
    kept = (f"list_reduce([[]::VARCHAR[]] || list_transform(string_split({path}, '/'), lambda p: [p]), lambda acc, p: CASE WHEN p[1] = '.' THEN acc "
            f"WHEN p[1] = '..' THEN acc[:greatest(len(acc) - 1, 1)] ELSE acc || p END)")
    return (rf"CASE WHEN regexp_matches({path}, '/\.\.?(/|$)') THEN array_to_string({kept}, '/') || "
            rf"CASE WHEN regexp_matches({path}, '/\.\.?$') THEN '/' ELSE '' END ELSE {path} END")


def _url_sql() -> str:
    q = lambda pattern: "'%s'" % pattern.replace("'", "''")
    parts = r"""regexp_extract(rest, '^[^/?#]*') AS h, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query"""
    low = "translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host"
    rest = lambda u: f"CASE WHEN contains({u}, '://') THEN substr({u}, strpos({u}, '://') + 3) ELSE '' END AS rest"
    key = f"CASE WHEN host <> '' THEN host || regexp_replace({_clear_sql('path')}, '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END END"
    body = f"regexp_replace(coalesce(html, ''), {q(urls.COMMENT)}, '', 'g')"
    tags = lambda tag, attribute: f"list_filter(regexp_extract_all(body, {q(tag)}), lambda t: regexp_matches(t, {q(attribute)}))"
    href = " || ".join(f"regexp_extract(t, {q(urls.HREF)}, {k})" for k in (1, 2, 3))
    plain = "x"
    for written in urls.AMPERSANDS:
        plain = f"replace({plain}, '{written}', '&')"
    root = "CASE WHEN host <> '' THEN regexp_extract(u, '^(.*?)://', 1) || '://' || host END"
    return f"""
WITH RECURSIVE p AS (SELECT page_id, u, html, host, path, {key} AS node, {_rule_sql('host', 'path', 1)} AS rule, {_rule_sql('host', 'path', 0)} AS own
      FROM (SELECT *, {low} FROM (SELECT *, {parts} FROM (SELECT page_id, html, u, {rest('u')} FROM (SELECT page_id, html, coalesce(url, '') AS u FROM pages))))),
tags AS (SELECT u, host, path, node, unnest(list_transform({tags(urls.LINK_TAG, urls.CANONICAL)}, lambda t: {href})
                || list_transform({tags(urls.META_TAG, urls.REFRESH)}, lambda t: regexp_extract(t, {q(urls.TARGET)}, 1))) AS x
         FROM (SELECT *, {body} AS body FROM p)),
raw AS (SELECT u, host, path, node, trim({plain}) AS x FROM tags),
far AS (SELECT node AS a, CASE WHEN regexp_matches(x, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN x
               WHEN starts_with(x, '//') THEN coalesce(nullif(regexp_extract(u, '^(.*?)://', 1), ''), 'http') || ':' || x
               WHEN starts_with(x, '/') THEN {root} || x WHEN regexp_matches(x, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
               WHEN regexp_matches(x, '^[?#]') THEN {root} || path || x
               ELSE {root} || coalesce(nullif(regexp_extract(path, '^.*/'), ''), '/') || x END AS u FROM raw WHERE x <> ''),
e AS (SELECT DISTINCT a, {key} AS b, {_rule_sql('host', 'path', 0)} AS v
      FROM (SELECT a, host, query, {_clear_sql('path')} AS path FROM (SELECT *, {low} FROM (SELECT *, {parts} FROM (SELECT a, {rest('u')} FROM far WHERE u IS NOT NULL))))
      WHERE host <> '' AND a IS NOT NULL),
both_ways AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
blocked AS (SELECT node FROM p WHERE own = 'block' UNION SELECT b FROM e WHERE v = 'block' AND a <> b),
reach(node) AS (SELECT node FROM blocked UNION SELECT b FROM reach JOIN both_ways ON reach.node = both_ways.a)
SELECT page_id, host, path, rule, coalesce(own, CASE WHEN node IN (SELECT node FROM reach WHERE node IN (SELECT a FROM both_ways))
       THEN 'block' ELSE 'allow' END) AS verdict FROM p
"""


#: crc32 of the decimal id, bit by bit.
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda k: ascii(substr(doc_id::VARCHAR, k::INT, 1))::BIGINT),
 lambda a, b: list_reduce([xor(a, b)] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295)"""

OP11_SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC} AS h FROM documents),
g AS (SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g FROM w),
p AS (SELECT doc_id, n, w, h % 10 = 0 AND n > 0 AS hit, CASE WHEN n > 0 THEN g % n END AS a, CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM g),
d AS (SELECT doc_id, n, CASE WHEN hit THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM p),
f AS (SELECT doc_id, n, k, array_to_string(w[k + 1:k + 5], ' ') AS five FROM (SELECT doc_id, n, w, unnest(range(n - 4)) AS k FROM d WHERE n > 5)),
eq AS (SELECT x.doc_id, x.k, y.k - x.k AS q FROM f x JOIN f y ON x.doc_id = y.doc_id AND x.five = y.five AND y.k > x.k AND 4 * (y.k - x.k) <= x.n),
isle AS (SELECT doc_id, q, min(k) AS s, count(*) + 4 + q AS size
         FROM (SELECT *, k - row_number() OVER (PARTITION BY doc_id, q ORDER BY k) AS part FROM eq) GROUP BY doc_id, q, part),
r AS (SELECT doc_id, s, size, min(q) AS q FROM isle WHERE size >= greatest(6, 4 * q) GROUP BY doc_id, s, size),
best AS (SELECT doc_id, s, size, q FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY size::DOUBLE / q DESC, s, q) = 1),
runs AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM r GROUP BY doc_id),
lost AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + size)) AS k FROM r),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS t FROM
         (SELECT doc_id, unnest(range(n)) AS k, unnest(w) AS x FROM d) ANTI JOIN lost USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, size AS length, q AS period, 1000 * size // q AS exponent_milli,
       sha256(coalesce(runs.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN runs USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _leaf_sql(text: str) -> str:
    part = lambda x: f"coalesce(octet_length(encode({x}::VARCHAR)) || ':' || {x}, '-')"
    return "sha256(%s)" % " || ".join(part(text if c == "text" else c) for c in manifest.FIELDS)


def _tree_sql(name: str, base: str) -> str:
    """Levels over ``base`` (grp, idx, digest), one row a node; ``n`` counts the nodes of its level."""
    return f"""
{name}(grp, level, idx, digest, n) AS (
  SELECT grp, 0, idx, digest, count(*) OVER (PARTITION BY grp) FROM {base}
  UNION ALL
  SELECT grp, any_value(level) + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 7) // 8
  FROM {name} WHERE n > 1 GROUP BY grp, idx // 8)"""


OP12_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, lang, {_leaf_sql('text')} AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered FROM documents),
leaves AS (SELECT *, coalesce('1' || lang, '0') AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM docs),
low AS (SELECT grp, idx, leaf AS digest FROM leaves),
{_tree_sql('tree', 'low')},
subs AS (SELECT grp, digest, level, row_number() OVER (ORDER BY grp) - 1 AS place FROM tree WHERE n = 1),
high AS (SELECT 0 AS grp, place AS idx, digest FROM subs),
{_tree_sql('top', 'high')},
steps AS (
  SELECT l.doc_id, l.leaf, l.grp, t.level AS step, t.idx, l.idx // CAST(8 ** t.level AS BIGINT) AS own, t.digest
  FROM leaves l JOIN tree t ON t.grp = l.grp AND t.n > 1 AND t.idx // 8 = l.idx // CAST(8 ** (t.level + 1) AS BIGINT)
  UNION ALL
  SELECT l.doc_id, l.leaf, l.grp, s.level + t.level, t.idx, s.place // CAST(8 ** t.level AS BIGINT), t.digest
  FROM leaves l JOIN subs s ON s.grp = l.grp JOIN top t ON t.n > 1 AND t.idx // 8 = s.place // CAST(8 ** (t.level + 1) AS BIGINT)),
sides AS (SELECT doc_id, step, coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx < own), '') AS before,
                 coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx > own), '') AS after FROM steps GROUP BY doc_id, step),
proofs AS (SELECT doc_id, string_agg(before || after, '' ORDER BY step) AS proof FROM sides GROUP BY doc_id),
folds(doc_id, step, digest) AS (
  SELECT doc_id, 0, coalesce(tampered, leaf) FROM leaves
  UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(s.before || f.digest || s.after) FROM folds f JOIN sides s ON s.doc_id = f.doc_id AND s.step = f.step),
ends AS (SELECT doc_id, arg_max(digest, step) AS digest FROM folds GROUP BY doc_id)
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, e.digest AS folded_root,
       e.digest = r.digest AS verified
FROM leaves l JOIN subs s USING (grp) JOIN (SELECT digest FROM top WHERE n = 1) r ON true LEFT JOIN proofs p ON p.doc_id = l.doc_id JOIN ends e ON e.doc_id = l.doc_id
"""

OP13_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

QUERIES = {f.__name__: f for f in (op1_pii_spans, op2_decontaminate, op3_lm_score, op4_url_filter, op5_quality_rules, op6_jaccard_join,
                                   op7_sentencepiece, op8_line_dedup, op9_licence_scan, op10_secret_scan, op11_periods, op12_manifest, op13_topk)}

#: None for operators with a trained model (1, 3, 5, 10) or a tokenizer (7): tests hold those against brute force.
ORACLES = {"op2_decontaminate": OP2_SQL, "op4_url_filter": _url_sql(), "op6_jaccard_join": OP6_SQL, "op8_line_dedup": OP8_SQL,
           "op9_licence_scan": _licence_sql(), "op11_periods": OP11_SQL, "op12_manifest": OP12_SQL, "op13_topk": OP13_SQL}
