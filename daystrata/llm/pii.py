"""Personal data in texts: patterns propose spans, check digits and ranges confirm them, and words
nearby move their scores.

Four base kinds are kept whatever their score (``email``, ``ip``, ``card``, ``phone``). Further kinds
(``iban`` by mod-97, ``ssn`` and ``tel`` by form and nearby words) are kept from ``THRESHOLD`` on
where they do not overlap a base span. Everything is decided within one text, so the operator is one narrow pass.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.llm.words import shipped, slices, string_texts

THRESHOLD = 0.6
#: Code points before and after a span whose words count as nearby.
BEFORE, AFTER = 48, 24


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes; ``score`` is what a confirmed span starts with; a ``near`` word adds
    ``RAISE`` to it and an ``against`` word takes ``LOWER`` away."""

    name: str
    pattern: str
    score: float
    near: tuple[str, ...]
    against: tuple[str, ...] = ()
    base: bool = False


RAISE, LOWER = 0.3, 0.2

# Characters of an IBAN by country (ISO 13616 registry).
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26,
    "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15,
    "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}
_IBAN = "|".join(f"{country}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for country, n in IBAN_LENGTHS.items())

# In the order in which spans with one start are listed.
KINDS = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0.9,
         ("email", "mail", "contact", "write"), base=True),
    Kind("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", 0.6,
         ("ip", "address", "host", "server", "login"), ("version", "release"), base=True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])+", 0.7,
         ("card", "visa", "mastercard", "credit", "payment"), ("isbn", "order"), base=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7,
         ("phone", "tel", "call", "mobile", "fax"), ("isbn", "order"), base=True),
    Kind("iban", _IBAN, 0.8,
         ("iban", "account", "bank", "transfer"), ("order",)),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.4,
         ("ssn", "social", "security"), ("order", "isbn")),
    Kind("tel", r"(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}", 0.4,
         ("phone", "tel", "call", "mobile", "fax"), ("order", "isbn")),
)
ORDER = {kind.name: i for i, kind in enumerate(KINDS)}

_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_SSN = r"(?:00[1-9]|0[1-9][0-9]|[1-57-8][0-9]{2}|6[0-57-9][0-9]|66[0-57-9])-(?:0[1-9]|[1-9][0-9])-(?:[0-9]{3}[1-9]|[0-9]{2}[1-9]0|[0-9][1-9]00|[1-9]000)"

SPAN = T.StructType().add("kind", "string").add("start", "long").add("end", "long").add(
    "score", "double").add("base", "boolean")
_ARROW_SPAN = pa.struct([
    ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()),
    ("base", pa.bool_()),
])


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of those before it."""
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * (1 + i % 2)
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN without spaces has its check digits (ISO 7064)."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


class Finder:
    """Compiled patterns. Every search takes time in proportion to the text: no pattern tries the rest
    of a long run of characters again from each of its places."""

    # An address is looked for from its @ on, and then back; numbers begin where their digits do.
    _domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    _local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    _ip = re.compile(r"(?<![0-9])" + KINDS[1].pattern)
    _parts = re.compile(rf"{_BYTE}(?:\.{_BYTE}){{3}}")
    _digit = re.compile(r"[^0-9]")
    _any_digit = re.compile(r"[0-9][^A-Za-z]*[0-9]")
    _word = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")

    def __init__(self):
        self.plain = {kind.name: re.compile(kind.pattern) for kind in KINDS}
        self.ssn = re.compile(_SSN)
        self.near = {kind.name: _any_of(kind.near) for kind in KINDS}
        self.against = {kind.name: _any_of(kind.against) for kind in KINDS if kind.against}

    def emails(self, text: str):
        floor = 0
        for found in self._domain.finditer(text):
            at = start = found.start()
            while start > floor and text[start - 1] in self._local:
                start -= 1
            if start < at:
                floor = found.end()
                yield start, floor

    def ips(self, text: str):
        for found in self._ip.finditer(text):
            if self._parts.fullmatch(found.group()):
                yield found.span()

    def cards(self, text: str):
        for found in self.plain["card"].finditer(text):
            digits = self._digit.sub("", found.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield found.span()

    def phones(self, text: str):
        for found in self.plain["phone"].finditer(text):
            if 10 <= len(self._digit.sub("", found.group())) <= 15:
                yield found.span()

    def ibans(self, text: str):
        for found in self.plain["iban"].finditer(text):
            if self._alone(text, *found.span()) and mod97(found.group().replace(" ", "")):
                yield found.span()

    def ssns(self, text: str):
        for found in self.plain["ssn"].finditer(text):
            if self._alone(text, *found.span()) and self.ssn.fullmatch(found.group()):
                yield found.span()

    def tels(self, text: str):
        for found in self.plain["tel"].finditer(text):
            if self._alone(text, *found.span()):
                yield found.span()

    def _alone(self, text: str, start: int, end: int) -> bool:
        return (start == 0 or text[start - 1] not in self._word) and text[end : end + 1] not in self._word

    def score(self, text: str, kind: Kind, start: int, end: int) -> float:
        around = f"{text[max(0, start - BEFORE) : start]} | {text[end : end + AFTER]}"
        score = kind.score
        if self.near[kind.name].search(around):
            score += RAISE
        if kind.against and self.against[kind.name].search(around):
            score -= LOWER
        return round(min(score, 1.0), 2)

    def spans(self, text: str) -> list[tuple[str, int, int, float, bool]]:
        """``(kind, start, end, score, base)`` in code points, end exclusive, by start and kind."""
        found = [("email", *span) for span in self.emails(text)] if "@" in text else []
        if self._any_digit.search(text):
            for name, search in (("ip", self.ips), ("card", self.cards), ("phone", self.phones)):
                found += [(name, *span) for span in search(text)]
            more = [("iban", *span) for span in self.ibans(text)]
            more += [("ssn", *span) for span in self.ssns(text)]
            more += [("tel", *span) for span in self.tels(text)]
            if more:
                free = _Free([span for _, *span in found])
                found += [x for x in more if free.holds(x[1], x[2])]
        out = []
        for name, start, end in found:
            kind = KINDS[ORDER[name]]
            score = self.score(text, kind, start, end)
            if kind.base or score >= THRESHOLD:
                out.append((name, start, end, score, kind.base))
        return sorted(out, key=lambda x: (x[1], ORDER[x[0]]))


def _any_of(words: tuple[str, ...]) -> re.Pattern:
    return re.compile(_any_of_text(words))


def _any_of_text(words: tuple[str, ...]) -> str:
    """One of the words as a whole, in either case; plain ASCII, so every engine reads it alike."""
    cased = ["".join(f"[{c.upper()}{c}]" for c in word) for word in words]
    return rf"(?:^|[^A-Za-z])(?:{'|'.join(cased)})(?:[^A-Za-z]|$)"


class _Free:
    """What given spans, which may overlap each other, leave free."""

    def __init__(self, spans: list):
        self.starts = sorted(start for start, _ in spans)
        self.ends = list(accumulate((end for _, end in sorted(spans)), max))

    def holds(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return not before or self.ends[before - 1] <= start


def find(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)``: every row with its spans, an array of ``(kind, start, end, score, base)``.

    Null text counts as empty and has no spans; null ids and repeated rows stay, each a row of its own;
    spans of one start are listed in the order of ``KINDS``; spans of different base kinds may overlap;
    an empty table gives no rows; other columns are ignored, whatever their names. Very long texts are
    searched whole, in time in proportion to their length.
    """

    def run(batches):
        finder = Finder()
        for batch in slices(batches):
            found = [
                [dict(zip(SPAN.names, span)) for span in finder.spans(text)]
                for text in string_texts(batch)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(_ARROW_SPAN))], names=["doc_id", "spans"]
            )

    chosen = shipped(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    schema = T.StructType().add("doc_id", "long").add("spans", T.ArrayType(SPAN))
    return chosen.mapInArrow(run, schema)


def digests(found: DataFrame) -> DataFrame:
    """``find``'s spans counted and joined as text: ``kind:start:end`` by commas, and their scores."""

    def named(spans):
        joined = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(joined, ",")

    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.expr(f"size(filter(spans, s -> s.kind = '{kind.name}'))").cast("bigint").alias(f"n_{kind.name}")
        for kind in KINDS if kind.base
    ]
    scores = F.transform("spans", lambda s: F.format_string("%.2f", s["score"]))
    return found.select(
        "doc_id", *counts,
        F.sha2(named(base), 256).alias("base_sha256"),
        named(F.col("spans")).alias("spans"),
        F.array_join(scores, ",").alias("scores"),
    )


# -- the same in DuckDB's SQL ---------------------------------------------------------------------

_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
_LUHN = """list_sum(list_transform(range(length({d})), lambda i:
  case when i % 2 = 0 then substr({d}, length({d}) - i, 1)::int
       when substr({d}, length({d}) - i, 1)::int < 5 then 2 * substr({d}, length({d}) - i, 1)::int
       else 2 * substr({d}, length({d}) - i, 1)::int - 9 end)) % 10 = 0"""
_MOVED = "(substr(compact, 5) || substr(compact, 1, 4))"


def _proposed(kind: Kind, where: str, extra: str = "") -> str:
    """Spans of one kind: pieces between the matches tell where each match begins."""
    return f"""select rid, '{kind.name}' as kind, pos as start, pos + length(hit) as "end" from (
      select rid, t, hit, {extra}
        (sum(length(gap) + length(hit)) over (partition by rid order by i) - length(hit))::bigint as pos
      from (select rid, t, unnest(regexp_extract_all(t, '{kind.pattern}')) as hit,
        unnest(regexp_split_to_array(t, '{kind.pattern}')[:-2]) as gap,
        unnest(range(len(regexp_extract_all(t, '{kind.pattern}')))) as i
        from d where regexp_matches(t, '{kind.pattern}'))) where {where}"""


def find_sql() -> str:
    """DuckDB SQL for the digests over ``documents``."""
    alone = (
        "not (pos > 0 and regexp_matches(substr(t, pos::int, 1), '[A-Za-z0-9-]')) "
        "and not regexp_matches(substr(t, (pos + length(hit))::int + 1, 1), '[A-Za-z0-9-]')"
    )
    card = f"length({_DIGITS}) between 14 and 19 and case when length({_DIGITS}) between 14 and 19 then {_LUHN.format(d=_DIGITS)} end"
    mod = f"""list_reduce(list_transform(range(length(compact)), lambda k:
      case when substr({_MOVED}, k::int + 1, 1) between '0' and '9'
        then substr({_MOVED}, k::int + 1, 1)::int
        else ascii(substr({_MOVED}, k::int + 1, 1)) - 55 end)::bigint[],
      lambda a, b: (a * case when b > 9 then 100 else 10 end + b) % 97) = 1"""
    by_name = {kind.name: kind for kind in KINDS}
    base = [
        _proposed(by_name["email"], "true"),
        _proposed(by_name["ip"], f"regexp_full_match(hit, '{_BYTE}(?:\\.{_BYTE}){{3}}')"),
        _proposed(by_name["card"], card),
        _proposed(by_name["phone"], f"length({_DIGITS}) between 10 and 15"),
    ]
    more = [
        _proposed(by_name["iban"], f"{alone} and {mod}", "replace(hit, ' ', '') as compact,"),
        _proposed(by_name["ssn"], f"{alone} and regexp_full_match(hit, '{_SSN}')"),
        _proposed(by_name["tel"], alone),
    ]
    score = "case kind " + " ".join(
        f"when '{k.name}' then least({k.score} + case when regexp_matches(around, '{_any_of_text(k.near)}') "
        f"then {RAISE} else 0 end"
        + (f" - case when regexp_matches(around, '{_any_of_text(k.against)}') then {LOWER} else 0 end"
           if k.against else "") + ", 1.0)"
        for k in KINDS) + " end"
    rank = "case kind " + " ".join(f"when '{k.name}' then {i}" for i, k in enumerate(KINDS)) + " end"
    counts = ", ".join(
        f"count(*) filter (where kind = '{k.name}')::bigint as n_{k.name}" for k in KINDS if k.base)
    name = "kind || ':' || start || ':' || \"end\""
    return f"""with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
      base as ({' union all '.join(base)}), more as ({' union all '.join(more)}),
      every as (select *, true as base from base
        union all select *, false from more m where not exists
          (select 1 from base b where b.rid = m.rid and b.start < m."end" and b."end" > m.start)),
      scored as (select rid, kind, start, "end", base, {rank} as rank, round({score}, 2) as score from (
        select e.*, substr(t, greatest(start - {BEFORE}, 0)::int + 1, least(start, {BEFORE})::int) || ' | '
          || substr(t, "end"::int + 1, {AFTER}) as around from every e join d using (rid))),
      kept as (select * from scored where base or score >= {THRESHOLD}),
      told as (select rid, {counts}, string_agg({name}, ',' order by start, rank) filter (where base) as b,
        string_agg({name}, ',' order by start, rank) as s,
        string_agg(printf('%.2f', score), ',' order by start, rank) as scores from kept group by rid)
    select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card,
      coalesce(n_phone, 0) as n_phone, sha256(coalesce(b, '')) as base_sha256, coalesce(s, '') as spans,
      coalesce(scores, '') as scores from d left join told using (rid)"""
