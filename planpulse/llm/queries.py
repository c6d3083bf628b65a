"""The registered queries of this subpackage: each runs one operator over its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from planpulse.llm import bpe, htmltext, kdshard, langid, merkle, packing, phrases, quality, rules, simhash, tokenfile, urlfilter, winnow

#: Fixed values of the url query.
URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow",
             "com/de/": "block"}


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def op1_bpe(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, d), public_tokenizers.path("word_bpe_49k.json"))


def op2_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return rules.quality_rules(documents(spark, d))


def op3_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    return quality.score(docs, quality.train(docs, spark.read.parquet(f"{d}/labels.parquet")), threshold=0.3)


def op4_token_files(spark: SparkSession, d: str) -> DataFrame:
    return tokenfile.token_files(documents(spark, d), public_tokenizers.path("byte_bpe_50k.json"))


def op5_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(documents(spark, d), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op6_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return urlfilter.judge(spark.read.parquet(f"{d}/pages.parquet"), URL_RULES)


def op7_winnowing(spark: SparkSession, d: str) -> DataFrame:
    return winnow.edited_likeness(documents(spark, d), tokens=winnow.ROLLED)


def op8_kd_shards(spark: SparkSession, d: str) -> DataFrame:
    return kdshard.shard(documents(spark, d), 40)


def op9_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    return langid.predict(docs, langid.train(docs))


def op10_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, d), shingle=4, radius=4)


def op11_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return htmltext.extract(spark.read.parquet(f"{d}/pages.parquet"))


def op12_collocations(spark: SparkSession, d: str) -> DataFrame:
    return phrases.collocations(documents(spark, d), least=100, longest=5, top=2000)


def op13_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return merkle.manifest(documents(spark, d))


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_quality_rules, op3_quality_classifier, op4_token_files, op5_packing, op6_url_filter, op7_winnowing,
    op8_kd_shards, op9_language_id, op10_simhash, op11_html_extraction,
    op12_collocations, op13_merkle_manifest)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE_SQL = {
    "op2_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^ \t-\r]+') AS ws, string_split(t, chr(10)) AS ls FROM d),
        g AS (SELECT r, i, list_slice(ws, i, i + 7) AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
        twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
        rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
        l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup
              FROM (SELECT r, unnest(ls) AS x FROM w) WHERE regexp_matches(x, '[^ \t-\r]') GROUP BY r),
        f AS (SELECT doc_id, t, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                     (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
                     coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_dup, 0)::BIGINT AS n_dup_lines,
                     coalesce(rep.n, 0)::BIGINT AS n_repeat_words
              FROM w LEFT JOIN l USING (r) LEFT JOIN rep USING (r)),
        b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
                     len(regexp_extract_all(t, '\p{Lu}{2,}')) AS shouts, len(regexp_extract_all(t, '\p{L}+')) AS letter_runs,
                     length(t) - length(replace(t, '!', '')) AS bangs FROM f)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_symbols > 2 * n_words
                    OR 10 * n_dup_lines > 3 * n_lines OR 2 * shouts > n_words OR 10 * bangs > 5 * n_words
                    OR 2 * letter_runs < n_words) AS kept
        FROM b""",
    "op6_url_filter": """
        WITH cut AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS a FROM pages),
        parts AS (
            SELECT page_id, translate(coalesce(regexp_extract(a, '^[^/?#]*'), ''),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(substr(a, length(regexp_extract(a, '^[^/?#]*')) + 1), '^[^?#]*'), '') AS path
            FROM cut),
        ruled AS (
            SELECT page_id, host, path, CASE
                WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
            FROM parts)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled""",
    "op12_collocations": r"""
        WITH t AS (
            SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents),
        piece AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM t),
        pos AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM piece),
        sized AS (SELECT lang, ws, i, unnest(range(1, least(5, len(ws) - i + 1) + 1)) AS k FROM pos),
        f AS (SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS p, any_value(k) AS k, count(*) AS a
              FROM sized GROUP BY ALL HAVING count(*) >= 100),
        n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM piece GROUP BY lang),
        cand AS (SELECT lang, p, string_split(p, ' ') AS ws, k, a FROM f WHERE k >= 2),
        starts AS (SELECT *, unnest(range(1, k)) AS i FROM cand),
        spans AS (SELECT *, unnest(range(i + 1, k + 1)) AS j FROM starts),
        inside AS (SELECT lang, array_to_string(ws[i:j], ' ') AS p, max(a) AS longer FROM spans WHERE j - i + 1 < k GROUP BY ALL),
        cuts AS (
            SELECT lang, p, a, i AS q, array_to_string(ws[1:i], ' ') AS first, array_to_string(ws[i + 1:k], ' ') AS rest FROM starts),
        scored AS (
            SELECT c.lang, c.p, c.a, n.n, c.q, l.a AS l, r.a AS r, ((1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
            FROM cuts c JOIN n ON n.lang = c.lang JOIN f l ON l.lang = c.lang AND l.p = c.first
                 JOIN f r ON r.lang = c.lang AND r.p = c.rest
                 LEFT JOIN inside s ON s.lang = c.lang AND s.p = c.p
            WHERE s.longer IS NULL OR 100 * s.longer < 100 * c.a),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, q) = 1),
        ranked AS (
            SELECT lang, p AS phrase, a, l, r, n, score,
                   row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM best)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
    "op13_merkle_manifest": """
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, coalesce('=' || lang, '-') AS tree, doc_id, text, source, lang, n_chars FROM documents),
        field AS (
            SELECT r, tree, doc_id, text, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
                   || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   -- crc32 bit by bit: a byte, then eight shifts (-1)
                   (4294967295 - list_reduce([4294967295::BIGINT] || flatten(list_transform(
                        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                        lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1])),
                        lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) % 3 = 0 AS third
            FROM d),
        leaf AS (
            SELECT r, tree, doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN third THEN sha256(head || coalesce(strlen(text) || ':' || translate(text,
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed
            FROM field),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
            FROM leaf),
        node AS (
            SELECT tree, 0 AS level, i, n, leaf AS h FROM numbered
            UNION ALL
            SELECT tree, level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
            FROM node WHERE n > 1 GROUP BY tree, level, i // 8),
        sub AS (
            SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS j, count(*) OVER () AS m FROM node WHERE n = 1),
        top AS (
            SELECT 0 AS level, j, m, subroot AS h FROM sub
            UNION ALL
            SELECT level + 1, j // 8, (any_value(m) + 7) // 8, sha256(string_agg(h, '' ORDER BY j))
            FROM top WHERE m > 1 GROUP BY level, j // 8),
        -- the nodes beside each leaf's path: of its language's tree, then of the languages' tree
        beside AS (
            SELECT l.r, o.level, o.i, o.h, o.i < l.i // (8 ** o.level)::BIGINT AS lower
            FROM numbered l JOIN node o ON o.tree = l.tree AND o.n > 1 AND o.i // 8 = l.i // (8 ** (o.level + 1))::BIGINT
                 AND o.i <> l.i // (8 ** o.level)::BIGINT
            UNION ALL
            SELECT l.r, 100 + o.level, o.j, o.h, o.j < s.j // (8 ** o.level)::BIGINT
            FROM numbered l JOIN sub s ON s.tree = l.tree JOIN top o ON o.m > 1 AND o.j // 8 = s.j // (8 ** (o.level + 1))::BIGINT
                 AND o.j <> s.j // (8 ** o.level)::BIGINT),
        proof AS (SELECT r, sha256(string_agg(h, '' ORDER BY level, i)) AS p FROM beside GROUP BY r),
        -- a level without others still has its node digested: steps come from the trees' heights
        height AS (
            SELECT tree, level, false AS up FROM node WHERE n > 1 GROUP BY tree, level
            UNION ALL SELECT s.tree, 100 + t.level, true FROM sub s, (SELECT DISTINCT level FROM top WHERE m > 1) t),
        step AS (
            SELECT l.r, row_number() OVER (PARTITION BY l.r ORDER BY e.level) AS k,
                   coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.lower), '') AS before,
                   coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE NOT b.lower), '') AS after
            FROM numbered l JOIN height e ON e.tree = l.tree LEFT JOIN beside b ON b.r = l.r AND b.level = e.level
            GROUP BY l.r, e.level),
        fold AS (
            SELECT r, 0 AS k, coalesce(changed, leaf) AS h FROM numbered
            UNION ALL
            SELECT f.r, f.k + 1, sha256(s.before || f.h || s.after) FROM fold f JOIN step s ON s.r = f.r AND s.k = f.k + 1),
        last AS (SELECT r, arg_max(h, k) AS folded_root FROM fold GROUP BY r)
        SELECT l.doc_id, l.leaf, s.subroot, t.h AS root, coalesce(p.p, sha256('')) AS proof_sha256, f.folded_root,
               f.folded_root = t.h AS verified
        FROM numbered l JOIN sub s ON s.tree = l.tree JOIN top t ON t.m = 1 JOIN last f ON f.r = l.r
             LEFT JOIN proof p ON p.r = l.r""",
}
