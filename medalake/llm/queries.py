"""Registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from medalake.llm import (bpe, bradley_terry, conversations, decontamination, idcoder, order_minhash, packing,
                          pseudo_lm, quality_rules, ranking, secrets_scan, simhash, warc)
from medalake.llm.common import table
from medalake.session import shared_dir


def op1_quality_rules(spark, sf_dir):
    return quality_rules.judge(spark, table(spark, sf_dir, "documents"))


def op2_bpe(spark, sf_dir):
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_quality_classifier(spark, sf_dir):
    return bradley_terry.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_fingerprints(spark, sf_dir):
    return order_minhash.fingerprints(spark, table(spark, sf_dir, "documents"))


def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_secret_scan(spark, sf_dir):
    return secrets_scan.find_secrets(table(spark, sf_dir, "documents"))


def op7_simhash(spark, sf_dir):
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op8_warc(spark, sf_dir):
    made = warc.derivatives(warc.response_records(table(spark, sf_dir, "pages")))
    return made.withColumn("record_sha256", F.sha2("record", 256)).drop("record")


def op9_lm_scoring(spark, sf_dir):
    return pseudo_lm.score(spark, table(spark, sf_dir, "documents"))


def op10_token_ids(spark, sf_dir):
    path = shared_dir(spark, "llm", "token-ids")
    idcoder.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return idcoder.read_ids(spark, path)


def op11_conversation_repair(spark, sf_dir):
    return conversations.repair(spark, conversations.damage(table(spark, sf_dir, "conversations")))


def op12_decontamination(spark, sf_dir):
    return decontamination.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_ranked_search(spark, sf_dir):
    index = ranking.build_index(spark, table(spark, sf_dir, "documents"))
    return ranking.search(spark, index, table(spark, sf_dir, "benchmark"))


def queries():
    return {f.__name__: f for f in (
        op1_quality_rules, op2_bpe, op3_quality_classifier, op4_fingerprints, op5_packing, op6_secret_scan, op7_simhash,
        op8_warc, op9_lm_scoring, op10_token_ids, op11_conversation_repair, op12_decontamination,
        op13_ranked_search)}


_RATES = {"mean_len": "100 * word_chars // n_words", "symbol_rate": "1000 * n_symbols // word_chars",
          "dup_rate": "1000 * n_dup_lines // n_lines"}


def _quality_rules_sql() -> str:
    """The counts, sketches, fences and verdicts of op1 in DuckDB SQL."""
    rates = ", ".join(f"CASE WHEN n_words > 0 THEN {e} ELSE 0 END AS {r}" for r, e in _RATES.items())
    long = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rate, {r} AS v FROM rated WHERE NOT base_failed"
                              for r in _RATES)

    def quartiles(keys: str) -> str:
        by, part = f"{keys}, rate" if keys else "rate", f"{keys}, rate" if keys else "rate"
        return (f"SELECT {by}, max(total) AS total, min(bucket) FILTER (WHERE 4 * upto >= total) AS q25, "
                f"min(bucket) FILTER (WHERE 4 * upto >= 3 * total) AS q75 FROM (SELECT {by}, bucket, "
                f"sum(n) OVER (PARTITION BY {part} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {part}) AS total "
                f"FROM (SELECT {by}, bucket, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY ALL")

    slack = {"mean_len": 150, "symbol_rate": 50, "dup_rate": 400}
    fences = ", ".join(f"max(b + 4 * (b - a) + {s}) FILTER (WHERE rate = '{r}') AS {r}_max" for r, s in slack.items())
    good = " AND ".join(f"{r} <= {r}_max" for r in slack)
    return f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
places AS (SELECT rid, unnest(range(1, len(w) + 1)) AS i, w FROM base),
windows AS (SELECT rid, i, CASE WHEN i + 7 <= len(w) THEN array_to_string(w[i:i + 7], ' ') END AS win FROM places),
often AS (SELECT rid, i, CASE WHEN win IS NOT NULL AND count(*) OVER (PARTITION BY rid, win) > 1 THEN 1 ELSE 0 END AS f
          FROM windows),
covered AS (SELECT rid, max(f) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c FROM often),
repeats AS (SELECT rid, sum(c) AS n_repeat_words FROM covered GROUP BY rid),
counted AS (
  SELECT b.rid, doc_id, lang, source, len(w) AS n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM base b LEFT JOIN repeats r ON b.rid = r.rid),
rated AS (SELECT *, {rates}, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted),
sketch AS (
  SELECT lang, source, rate, v - v % (1::BIGINT << greatest(length(bin(v)) - 5, 0)) AS bucket, count(*) AS n
  FROM ({long}) GROUP BY ALL),
own AS ({quartiles("lang, source")}), bylang AS ({quartiles("lang")}), every AS ({quartiles("")}),
fenced AS (
  SELECT o.lang, o.source, o.rate,
         CASE WHEN o.total >= 50 THEN o.q25 WHEN g.total >= 50 THEN g.q25 ELSE e.q25 END AS a,
         CASE WHEN o.total >= 50 THEN o.q75 WHEN g.total >= 50 THEN g.q75 ELSE e.q75 END AS b
  FROM own o JOIN bylang g ON o.lang IS NOT DISTINCT FROM g.lang AND o.rate = g.rate JOIN every e ON o.rate = e.rate),
limits AS (SELECT lang, source, {fences}, max(a - 4 * (b - a) - 150) FILTER (WHERE rate = 'mean_len') AS mean_len_min
           FROM fenced GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {good} AND mean_len >= mean_len_min, false) AS kept,
       mean_len, symbol_rate, dup_rate
FROM rated r LEFT JOIN limits l ON r.lang IS NOT DISTINCT FROM l.lang AND r.source IS NOT DISTINCT FROM l.source"""


def _words_sql(column: str) -> str:
    """Words of a text: only A-Z lower-cased, then runs of ASCII letters, digits and characters outside ASCII."""
    folded = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({folded}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _decontamination_sql(window: int = 10) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words_sql("text")} AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_words_sql("text")} AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), {window}) AS size FROM items WHERE len(w) > 0),
wins AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS win
         FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
places AS (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i
           FROM d, (SELECT DISTINCT size FROM wins) WHERE len(w) >= size),
met AS (SELECT rid, i, p.size, item FROM (SELECT rid, i, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM places) p
        JOIN wins USING (size, win)),
hits AS (SELECT rid, count(DISTINCT place) AS n_hit
         FROM (SELECT DISTINCT rid, unnest(range(i, i + size)) AS place FROM met) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT rid, item FROM met) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN found USING (rid)"""


def _ranked_search_sql(top: int = 10) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words_sql("text")} AS w FROM documents),
q AS (SELECT row_number() OVER () AS query, item_id, unnest(list_distinct({_words_sql("text")})) AS term FROM benchmark),
held AS (SELECT rid, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM held),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
            FROM tf, whole GROUP BY term, docs),
scores AS (
  SELECT query, item_id, doc_id, rid,
         sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN weights USING (term) JOIN held USING (rid), whole GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST) AS rank
           FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {top}"""


def oracle_sql():
    return {"op1_quality_rules": _quality_rules_sql(), "op12_decontamination": _decontamination_sql(),
            "op13_ranked_search": _ranked_search_sql()}
