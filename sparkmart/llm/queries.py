"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (alignment, ann, chat, fingerprints, langid, licenses, neardup, packing, pii, sentencepieces,
               sharding, spelling, toxicity)
from .common import read


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(read(spark, sf_dir, "documents"), 16)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(read(spark, sf_dir, "documents"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severities(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(read(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(read(spark, sf_dir, "conversations"))


def op9_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_messages(read(spark, sf_dir, "conversations"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(read(spark, sf_dir, "documents"), by_chunk=True)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(read(spark, sf_dir, "documents")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_sharding": op2_sharding,
    "op3_langid": op3_langid,
    "op4_ann": op4_ann,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_neardup": op7_neardup,
    "op8_fingerprints": op8_fingerprints,
    "op9_chat": op9_chat,
    "op9_messages": op9_messages,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_spelling": op11_spelling,
    "op12_pii": op12_pii,
    "op13_alignment": op13_alignment,
}


def _licence_sql() -> str:
    """Every word of every template against every word of the texts, counted by relative position."""
    rows = ", ".join(f"({k}, '{t.label}', {t.base}, string_split('{t.text}', ' '), {licenses.key_place(t)}, "
                     f"{len(t.key.split())})" for k, t in enumerate(licenses.TEMPLATES))
    return f"""
        with t(t, label, base, words, first, n_key) as (values {rows}),
        postings as (select t, unnest(words) w, unnest(range(len(words))) k from t),
        docs as (select row_number() over () id, doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '{licenses.WORD}') body from documents),
        hits as (select id, unnest(body) w, unnest(range(len(body))) p from docs),
        met as (select id, t, p - k start, count(*) same,
                       count(*) filter (k >= first and k < first + n_key) in_key
                from hits join postings using (w) join t using (t) group by id, t, p - k),
        found as (select id, start, label, base, same / len(words) share from met join t using (t)
                  where in_key = n_key and same >= 0.75 * len(words))
        select doc_id, any_value(len(body)) n_words, count(*) filter (base) n_base,
               min(start) filter (base) first_word, max(start) filter (base) last_word,
               coalesce(string_agg(distinct label, ',' order by label) filter (base), '') base_labels,
               coalesce(string_agg(distinct label, ',' order by label), '') labels,
               coalesce(max(share), 0.0) score
        from docs left join found using (id) group by id, doc_id"""


def _pii_sql() -> str:
    """The kinds by their plain patterns: pieces and matches give the places, list functions the checks."""
    luhn = """list_sum(list_transform(range(1, length(d) + 1), lambda i:
                case when i % 2 = 0 then 2 * cast(substr(reverse(d), i, 1) as int)
                       - case when substr(reverse(d), i, 1) > '4' then 9 else 0 end
                     else cast(substr(reverse(d), i, 1) as int) end)) % 10 = 0"""
    mod97 = """list_reduce(list_prepend(0, list_transform(
                string_split(substr(replace(x, ' ', ''), 5) || left(x, 4), ''), lambda c:
                case when c >= 'A' then 100 + ascii(c) - 55 else ascii(c) - 48 end)), lambda r, v:
                case when v >= 100 then (r * 100 + v - 100) % 97 else (r * 10 + v) % 97 end) = 1"""
    octets = """list_max(list_transform(string_split(x, '.'), lambda p:
                case when length(ltrim(p, '0')) > 3 then 999
                     else cast('0' || ltrim(p, '0') as int) end)) <= 255"""
    kinds = [  # name, pattern, condition, score, with a context word, context words
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", 80, 100,
         "mail|contact|kontakt|correo|courriel|write to"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", octets, 60, 80,
         r"\bip\b|address|host|server|adresse|direcci"),
        ("card", r"[0-9]([\x20-]?[0-9])+", f"length(d) between 12 and 19 and {luhn}", 80, 100,
         "card|visa|credit|debit|karte|carte|tarjeta"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) between 9 and 15", 60, 80,
         r"phone|call|\btel|mobile|\bfax|telefon|llam"),
        ("iban", rf"\b{pii.iban_pattern()}\b", mod97, 80, 100, "iban|bank|account|konto|compte|cuenta"),
        ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "true", 20, 60,
         r"\bssn\b|social security|taxpayer"),
    ]
    parts = [f"""
        select id, {nth} nth, '{name}' kind, start, start + length(x) "end", case when near then {high}
               else {low} end score
        from (select id, x, regexp_replace(x, '[^0-9]', '', 'g') d,
                     regexp_matches(lower(right(p[i], 40) || chr(10) || left(p[i + 1], 40)), '{words}') near,
                     list_sum(list_transform(p[1:i], lambda y: length(y)))
                       + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0) start
              from (select id, m, p, unnest(range(1, len(m) + 1)) i, unnest(m) x
                    from (select id, regexp_extract_all(body, '{pattern}') m,
                                 string_split_regex(body, '{pattern}') p from docs) a) b) c
        where {valid}""" for nth, (name, pattern, valid, low, high, words) in enumerate(kinds)]
    return f"""
        with docs as (select row_number() over () id, doc_id, coalesce(text, '') body from documents),
        spans as (select *, kind || ':' || start || ':' || "end" span
                  from ({" union all ".join(parts)}) t where score >= 50)
        select doc_id, count(span) filter (kind = 'email') n_email, count(span) filter (kind = 'ip') n_ip,
               count(span) filter (kind = 'card') n_card, count(span) filter (kind = 'phone') n_phone,
               sha256(coalesce(string_agg(span, ',' order by start, nth)
                               filter (kind in ('email', 'ip', 'card', 'phone')), '')) base_sha256,
               coalesce(string_agg(span, ',' order by start, nth), '') spans,
               coalesce(string_agg(score, ',' order by start, nth), '') scores
        from docs left join spans using (id) group by id, doc_id"""


#: Plain readings of the contracts over whole tables.
ORACLES: dict[str, str] = {
    "op1_licenses": _licence_sql(),
    "op12_pii": _pii_sql(),
    "op9_chat": """
        with c as (
          select distinct conv_id, 'call-' || conv_id || '-' || turn call_id, turn, text
          from conversations where role = 'user'),
        r as (
          select conv_id, 'call-' || conv_id || '-' || (turn - 1) call_id, min(turn) turn,
                 arg_min(content, turn) content, count(*) n
          from (select distinct conv_id, turn, text content from conversations
                where role = 'assistant') a group by 1, 2),
        j as (
          select coalesce(c.conv_id, r.conv_id) conv_id, coalesce(c.call_id, r.call_id) call_id,
                 case when c.call_id is null then r.turn else c.turn end turn,
                 case when c.call_id is null then 'no_call' when r.call_id is null then 'no_result'
                      else 'linked' end status,
                 coalesce(r.n, 0) n_results,
                 case when c.call_id is not null then length(c.text) > 0 end valid,
                 case when c.call_id is not null and length(c.text) = 0
                      then '$.prompt: too short' end error,
                 '{' || case when c.call_id is not null then '"arguments":{"prompt":' ||
                   to_json(c.text) || ',"turn":' || c.turn || '},' else '' end
                 || '"id":' || to_json(coalesce(c.call_id, r.call_id))
                 || case when c.call_id is not null then ',"name":"respond"' else '' end
                 || ',"result":' || coalesce(to_json(r.content), 'null') || '}' json
          from c full outer join r on c.call_id = r.call_id)
        select conv_id, row_number() over (partition by conv_id order by turn, call_id) - 1 "position",
               call_id, turn, status, n_results, valid, error, json from j""",
}
