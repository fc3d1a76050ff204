"""Registered queries of the subpackage: one per operator, over whole tables.

An operator that SQL can express has its DuckDB equivalent in ``ORACLE``; the others are tested
against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raresight.llm import bpe, divergence, fingerprints, jaccard, licences, lines, packing, quality, spelling, substring, token_files, token_ids, urls, warc
from raresight.llm.common import documents, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


RANKS = "byte_bpe_50k.tiktoken"


@register("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = token_ids.vocabulary_path(RANKS)
    encoded = bpe.encode(documents(spark, sf_dir), ranks)
    digest = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                            F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "ids", "offsets")
    return bpe.decode(digest, ranks, keep=("doc_id", "n_tokens", "ids_sha256")).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), token_ids.vocabulary_path(), end_id=1, capacity=2048, added=True)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(documents(spark, sf_dir), token_ids.vocabulary_path(), end_id=2, added=True)
    return token_files.read_token_files(manifest, with_ids=False)


@register("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last quarter of each text is replaced by the start of the next document's."""
    chained = fingerprints.with_next(documents(spark, sf_dir))
    edited = chained.select("doc_id", "text", "next_text", F.char_length("text").cast("long").alias("n_chars")).withColumn(
        "edited", F.expr("concat(substring(text, 1, int(n_chars - n_chars div 4)), substring(next_text, 1, int(n_chars div 4)))"))
    marked = edited.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    out = fingerprints.fingerprints(marked, ["text", "edited", "next_text"], ["fingerprint", "edited_fingerprint", "next_fingerprint"],
                                    keep=("doc_id", "n_chars", "edited_sha256"))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      fingerprints.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                      fingerprints.likeness("fingerprint", "next_fingerprint").alias("near_next"))


@register("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# The listed rules of the contract.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def url_rule_sql() -> str:
    """The longest rule first, as the branches of a CASE."""
    out = []
    for verdict, rule in sorted(URL_RULES, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        out.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') THEN '{rule}'")
    return " ".join(out)


OP3_SQL = rf"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS r FROM pages),
cut AS (SELECT page_id, translate(coalesce(regexp_extract(r, '^[^/?#]*', 0), ''), '{urls.UPPER}', '{urls.LOWER}') AS host,
               coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
ruled AS (SELECT *, CASE {url_rule_sql()} END AS rule FROM cut),
looks AS (SELECT *, CASE WHEN rule IN ({", ".join(f"'{r}'" for v, r in URL_RULES if v == "block")}) THEN 1 WHEN rule IS NOT NULL THEN 0 END AS label,
                 list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: regexp_replace(s, '{urls.VARIABLE}', '*\2')) AS looks FROM ruled),
steps AS (SELECT DISTINCT host, i AS lvl, array_to_string(looks[1:i - 1], '/') AS parent, looks[i] AS look
          FROM (SELECT host, looks, unnest(range(1, len(looks) + 1)) AS i FROM looks)),
many AS (SELECT host, lvl, parent FROM steps GROUP BY ALL HAVING count(*) > 50),
levels AS (SELECT host, list(lvl || ' ' || parent) AS many FROM many GROUP BY host),
shaped AS (SELECT l.* EXCLUDE (looks), '/' || array_to_string(list_transform(looks, lambda s, i:
             CASE WHEN list_contains(coalesce(many, []), i || ' ' || array_to_string(looks[1:i - 1], '/')) THEN '*' ELSE s END), '/') AS template
           FROM looks l LEFT JOIN levels USING (host)),
labelled AS (SELECT host, template, count(*) AS n, sum(label) AS bad FROM shaped WHERE label IS NOT NULL GROUP BY ALL),
trees AS (SELECT *, regexp_replace(template, '/[^/*]+((/\*[^/]*)*)$', '/+\1') AS parent FROM labelled),
shares AS (SELECT *, sum(bad) OVER w / sum(n) OVER w AS common FROM trees WINDOW w AS (PARTITION BY host, parent)),
alike AS (SELECT *, n >= 5 AND pow(bad / n - common, 2) * n <= 4 * common * (1 - common) + 1e-12 AS alike FROM shares),
pooled AS (SELECT host, template, CASE WHEN alike THEN sum(n) OVER w ELSE n END AS n, CASE WHEN alike THEN sum(bad) OVER w ELSE bad END AS bad
           FROM alike WINDOW w AS (PARTITION BY host, parent, alike)),
rejected AS (SELECT host, template FROM pooled WHERE bad + 1 >= 0.8 * (n + 2))
SELECT page_id, host, path, rule, CASE WHEN label = 1 THEN 'block' WHEN label = 0 THEN 'allow' WHEN r.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM shaped s LEFT JOIN rejected r USING (host, template)
"""


@register("op3_url_filter", sql=OP3_SQL)
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return urls.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP6_NUMBERS = {name: i for i, name in enumerate(licences.SENTENCES)}
OP6_SQL = rf"""
WITH known(id, name, sentence) AS (VALUES {", ".join(f"({i}, '{n}', ' {licences.SENTENCES[n]} ')" for n, i in OP6_NUMBERS.items())}),
rules(rule, licence, pattern, longer) AS (VALUES {", ".join(f"({k}, '{name}', '{'.*'.join(f' {OP6_NUMBERS[i]} ' for i in ids)}', {longer}::INT[])"
                                                             for k, ((name, ids), longer) in enumerate(zip(licences.RULES, licences.longer_rules(licences.RULES))))}),
cut AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '{licences.SIGNS}', '\1', 'g'), '{licences.BLANK}', chr(1), 'g'),
          '{licences.MARK}', chr(1), 'g'), chr(1)), lambda s: trim(regexp_replace(translate(s, '{licences.UPPER}', '{licences.LOWER}'), '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') AS sentences FROM documents),
said AS (SELECT doc_id, ' ' || unnest(sentences) || ' ' AS s, unnest(range(1, len(sentences) + 1)) AS place FROM cut),
met AS (SELECT doc_id, list(id ORDER BY place, spot, id) AS ids, string_agg(name, ',' ORDER BY place, spot, id) AS sentence_ids, min(place) - 1 AS first_sentence
        FROM (SELECT doc_id, place, id, name, instr(s, sentence) AS spot FROM said JOIN known ON contains(s, sentence)) GROUP BY doc_id),
paths AS (SELECT *, ' ' || array_to_string(ids, '  ') || ' ' AS path FROM met),
matched AS (SELECT doc_id, list(rule) AS met_rules FROM paths JOIN rules ON regexp_matches(path, pattern) GROUP BY doc_id),
found AS (SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM matched JOIN rules ON list_contains(met_rules, rule) AND NOT list_has_any(longer, met_rules) GROUP BY doc_id)
SELECT doc_id, CAST(len(sentences) AS BIGINT) AS n_sentences, coalesce(sentence_ids, '') AS sentence_ids, first_sentence, coalesce(licences, '') AS licences
FROM cut LEFT JOIN met USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@register("op6_licences", sql=OP6_SQL)
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(documents(spark, sf_dir))
    return found.select("doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), "first_sentence", F.array_join("licences", ",").alias("licences"))


@register("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.dedup_substrings(documents(spark, sf_dir), window=20))


@register("op5_ngram_jaccard")
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(documents(spark, sf_dir), size=4, percent=85)


OP4_SQL = r"""
WITH lines AS (SELECT doc_id AS d, place - 1 AS l, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
               FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS place FROM documents)),
firsts AS (SELECT words, min(struct_pack(d := d, l := l)) AS home FROM lines WHERE len(words) > 0 GROUP BY words),
variants AS (SELECT home, len(words) AS n, 0 AS pos, array_to_string(words, ' ') AS rest FROM firsts WHERE len(words) >= 2
             UNION ALL
             SELECT home, n, pos, array_to_string(list_concat(words[1:pos - 1], words[pos + 1:]), ' ') FROM (SELECT home, words, len(words) AS n, unnest(range(1, len(words) + 1)) AS pos FROM firsts WHERE len(words) >= 2)),
near AS (SELECT home FROM (SELECT home, pos, min(home) OVER (PARTITION BY rest, pos) AS same, min(CASE WHEN pos = 0 THEN home END) OVER (PARTITION BY rest) AS whole,
                                min(CASE WHEN pos > 0 THEN home END) OVER (PARTITION BY rest) AS shorter FROM variants)
         WHERE (pos > 0 AND (same < home OR whole < home)) OR (pos = 0 AND shorter < home)),
gone AS (SELECT d, l FROM lines JOIN firsts USING (words) WHERE home < struct_pack(d := d, l := l) UNION SELECT home.d, home.l FROM near),
lists AS (SELECT d, list(l) AS ls FROM gone GROUP BY d)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(coalesce(ls, []), i - 1)), chr(10)), '')) AS kept_sha256
FROM documents LEFT JOIN lists ON d = doc_id
"""


@register("op4_line_dedup", sql=OP4_SQL)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP11_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}') AS t FROM documents),
found AS (SELECT d, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT d) AS docs FROM found GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL HAVING sum(docs) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
gs AS (SELECT DISTINCT lang, source FROM docs),
cells AS (SELECT gs.lang, source, kept.term, coalesce(c.n, 0) AS n, kept.n AS n_lang FROM gs JOIN kept USING (lang) LEFT JOIN counts c USING (lang, source, term)),
totals AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS own FROM cells),
shares AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)::HUGEINT) // (own + 2 * v) AS p, 1 + (1000000000 * (n_lang + 2)::HUGEINT) // (total + 2 * v) AS q FROM totals JOIN langs USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
both_parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM gs a JOIN gs b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
               UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM both_parts QUALIFY part = 'pair' OR rank <= 10
"""


@register("op11_source_divergence", sql=OP11_SQL)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


@register("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir), min_length=6, min_count=5, ratio=5, edit_every=199)


OP12_SQL = """
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digits AS (SELECT *, sha1(payload) AS sha, max(page_id) OVER (PARTITION BY payload) AS first FROM payloads),
parts AS (SELECT *, list_transform([1, 11, 21, 31], lambda i: CAST('0x' || sha[i:i + 9] AS BIGINT)) AS fives FROM digits)
SELECT page_id, octet_length(payload) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((fives[i // 8 + 1] >> (35 - 5 * (i % 8))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM parts
"""


@register("op12_warc", sql=OP12_SQL)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses are read with their payloads, revisits by their headers alone."""
    path = warc.archive(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"), min_bytes=0)
    heads = ["record_type", "record_id", "refers_to", "payload_digest", "payload_length"]
    full = warc.read_warc(spark, path, ["record_type", "record_id", "payload"]).filter("record_type = 'response'")
    again = warc.read_warc(spark, path, heads).filter("record_type = 'revisit'")
    return full.select(warc.key_of("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), warc.base32_of(F.sha1("payload")).alias("payload_digest"),
                       "record_type", F.lit(None).cast("long").alias("refers_to")).union(
        again.select(warc.key_of("record_id"), "payload_length", warc.bare_digest("payload_digest"), "record_type", warc.key_of("refers_to")))
