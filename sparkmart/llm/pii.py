"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score (operator 12).

1. A gate that every match passes (a character or a short pattern) spares most texts the searches.
2. Each kind's pattern cuts the text into its leftmost non-overlapping matches and the pieces between
   them.  Lengths of pieces and matches give the places of the matches in code points: prefix sums, taken
   in blocks so that a text with very many matches stays linear.
3. Validators confirm or drop a match: parts of an IP address, the Luhn sum of a card number, the number
   of digits of a phone number, the mod-97 sum of an IBAN.  Dropped matches are not tried again.
4. A span's score is its kind's prior, more if a checksum confirmed it, more if a context word stands
   within ``CONTEXT`` code points before or after it (up to the kind's neighbouring match).  Spans below
   ``min_score`` go; the base kinds' priors lie above the default, so all their spans stay.

The patterns say "not after a character that would have begun the match earlier" and never give back what
they took, which changes no match and keeps the search linear in a text of any form.

Cases: null and empty texts have no spans; the order and number of rows, null or repeated ids and further
columns are kept apart from the text; spans of different kinds may overlap and all stay; no rows give no
rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points before and after a match that are searched for context words.
CONTEXT = 40
BLOCK = 256  # matches whose places are summed in one piece

#: Lengths of IBANs by country.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27,
}


def iban_pattern() -> str:
    """Country, two check digits and as many letters or digits as the country asks for."""
    by_length: dict[int, list[str]] = {}
    for country, n in IBAN_LENGTHS.items():
        by_length.setdefault(n, []).append(country)
    return "(?:" + "|".join(f"(?:{'|'.join(cs)})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}"
                            for n, cs in sorted(by_length.items())) + ")"


@dataclass(frozen=True)
class Kind:
    name: str
    gate: str  # SQL condition on ``text`` that holds wherever the pattern matches
    pattern: str
    valid: str  # SQL condition on the match ``m.x`` and its digits ``m.d``
    prior: int  # score in hundredths
    confirmed: int  # added for a match that a checksum confirmed
    near: int  # added for a context word
    words: str  # pattern of the context words, lower case


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_LUHN = ("aggregate(sequence(1, length(m.d)), 0, (s, i) -> s + case when i % 2 = 0 "
         "then 2 * (ascii(substr(reverse(m.d), i, 1)) - 48) "
         "- if(ascii(substr(reverse(m.d), i, 1)) > 52, 9, 0) "
         "else ascii(substr(reverse(m.d), i, 1)) - 48 end) % 10 = 0")
_MOD97 = ("aggregate(split(concat(substr(replace(m.x, ' ', ''), 5), left(m.x, 4)), ''), 0, (r, c) -> "
          "case when c = '' then r when c < 'A' then (r * 10 + ascii(c) - 48) % 97 "
          "else (r * 100 + ascii(c) - 55) % 97 end) = 1")

#: The base kinds, in the order that settles spans of one start, then the others.
KINDS = (
    Kind("email", "contains(text, '@')",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "true", 80, 0, 20, "mail|contact|kontakt|correo|courriel|write to"),
    Kind("ip", r"text rlike r'[0-9]\.[0-9]'",
         r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         rf"m.x rlike r'^{_OCTET}(?:\.{_OCTET}){{3}}$'",
         60, 0, 20, r"\bip\b|address|host|server|adresse|direcci"),
    Kind("card", r"text rlike r'(?:[0-9][\x20-]?){11}[0-9]'",
         r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
         f"case when length(m.d) between 12 and 19 then {_LUHN} else false end",
         50, 30, 20, "card|visa|credit|debit|karte|carte|tarjeta"),
    Kind("phone", r"text rlike r'\+[0-9]'", r"\+[0-9][\x20().0-9-]+[0-9]",
         "length(m.d) between 9 and 15", 60, 0, 20,
         r"phone|call|\btel|mobile|\bfax|telefon|llam"),
    Kind("iban", "text rlike r'[A-Z]{2}[0-9]{2}'",
         rf"(?<![A-Za-z0-9_]){iban_pattern()}(?![A-Za-z0-9_])", _MOD97,
         30, 50, 20, "iban|bank|account|konto|compte|cuenta"),
    Kind("ssn", r"text rlike r'[0-9]{3}-[0-9]{2}-[0-9]{4}'",
         r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])", "true",
         20, 0, 40, r"\bssn\b|social security|taxpayer"),
)
BASE = ("email", "ip", "card", "phone")


def _starts(lengths: str) -> str:
    """SQL: where each match starts, from an array of structs (gap, n): code points since the match before,
    and of the match."""
    block = (f"aggregate(slice({lengths}, k * {BLOCK} + 1, {BLOCK}), "
             "named_struct('at', 0L, 'out', cast(array() as array<bigint>)), (a, l) -> named_struct("
             "'at', a.at + l.gap + l.n, 'out', concat(a.out, array(a.at + l.gap))))")
    blocks = (f"case when size({lengths}) > 0 then transform(sequence(0, (size({lengths}) - 1) div {BLOCK}), "
              f"k -> {block}) end")
    return blocks


def _candidates(docs: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """``id`` and per kind the array ``m_<kind>`` of candidates: place, match, its digits, its surroundings."""
    cut, measured, placed = ["id"], ["id"], ["id"]
    for k in kinds:
        name = k.name
        cut += [f"case when {k.gate} then regexp_extract_all(text, r'{k.pattern}', 0) "
                f"else cast(array() as array<string>) end as x_{name}",
                f"case when {k.gate} then split(text, r'{k.pattern}', -1) "
                f"else cast(array() as array<string>) end as p_{name}"]
        measured += [
            f"transform(x_{name}, (x, i) -> named_struct('x', x, 'd', regexp_replace(x, '[^0-9]', ''), "
            f"'near', lower(concat(right(p_{name}[i], {CONTEXT}), '\\n', left(p_{name}[i + 1], {CONTEXT}))) "
            f"rlike r'{k.words}', 'n', length(x))) as c_{name}",
            _starts(f"transform(x_{name}, (x, i) -> named_struct('gap', length(p_{name}[i]), "
                    f"'n', length(x)))") + f" as b_{name}"]
        bases = (f"aggregate(b_{name}, named_struct('at', 0L, 'out', cast(array() as array<bigint>)), "
                 "(a, b) -> named_struct('at', a.at + b.at, 'out', concat(a.out, array(a.at)))).out")
        placed += [f"c_{name}", f"b_{name}", f"case when b_{name} is not null then {bases} end as o_{name}"]
    return (docs.selectExpr(*cut).selectExpr(*measured).selectExpr(*placed))


def _spans(k: Kind, order: int, min_score: int) -> str:
    """SQL: the accepted spans of a kind."""
    start = (f"b_{k.name}[i div {BLOCK}].out[i % {BLOCK}] + o_{k.name}[i div {BLOCK}]")
    made = (f"transform(c_{k.name}, (m, i) -> named_struct('start', {start}, 'nth', {order}, "
            f"'end', {start} + m.n, 'kind', '{k.name}', 'text', m.x, 'context', m.near, 'score', "
            f"{k.prior + k.confirmed} + if(m.near, {k.near}, 0), 'ok', {k.valid}))")
    return f"filter({made}, s -> s.ok and s.score >= {min_score})"


def scan(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, *, min_score: int = 50,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and ``spans``, an array of structs in the order of start and kind:
    ``start, nth, end, kind, text, context, score`` (code points, end exclusive; ``nth`` is the kind's place
    in ``kinds``; score in hundredths)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = _candidates(rows, kinds).selectExpr(
        "id", *[_spans(k, i, min_score) + f" as s_{k.name}" for i, k in enumerate(kinds)])
    every = F.array_sort(F.concat(*[F.col(f"s_{k.name}") for k in kinds]))
    kept = F.transform(every, lambda s: s.dropFields("ok"))
    return found.select(F.col("id").alias(id_col), kept.alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns from ``scan``'s rows; ``scores`` holds the spans' scores, joined likewise."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        id_col, *[count(kind) for kind in BASE], F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"))
