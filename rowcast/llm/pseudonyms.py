"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses.

Values are found by pattern, validated, and replaced by a keyed permutation of
their own format: the same value gives the same pseudonym in every document,
different values never meet, lengths and separators stay. Who holds the key
can invert it.

| kind | valid if | permuted |
| --- | --- | --- |
| email | local part of up to 64 characters, domain | letters and digits of the local part |
| secret | 32 to 64 hex digits standing alone | digits among digits, letters among a-f |
| iban | remainder 1 modulo 97 | account part; check digits follow |
| ssn | area, group and serial in use | all numbers in use |
| date | a day of 1700 to 2099, as Y-M-D, D.M.Y or M/D/Y | all these days |
| ip | four numbers up to 255 | all addresses |
| phone | country code or area code with separators, 7 to 15 digits | all digits but the country code |
| card | 13 to 19 digits, plain or in fours, Luhn | all digits; the check digit follows |

What looks like one of these but is not valid stays as it is, and what starts
inside it is looked at all the same. IBANs and phone numbers in groups end after
the last group that leaves them valid (an IBAN of a known country at its length),
so a value that follows after one space is found on its own. Outside +1, phone
numbers have no fixed length: a bare group of two to four digits right after one
is taken for its end, up to 15 digits. Where values overlap, the first wins. NULL texts stay
NULL; texts without a match are not touched. No row is dropped, and all other
columns are kept. Names that clash with the added ones are replaced.

All work is done by SQL functions within the row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "secret", "iban", "ssn", "date", "ip", "phone", "card")

# One pattern finds all kinds; every alternative starts at a boundary and takes
# its run possessively, so a long run of word characters is walked once.
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
_SECRET = r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,64}+(?![0-9A-Za-z])"
_IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?|[0-9A-Z]{11,30})(?![0-9A-Za-z])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-]|\.[0-9])"
_IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
_CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:(?: [0-9]{4}){3}|(?:-[0-9]{4}){3})|[0-9]{4} [0-9]{6} [0-9]{5})(?![0-9A-Za-z])"
_LOCAL = r"[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
# A further group of a phone number does not start a value that cannot be its end,
# nor, once there are seven digits, anything that looks like another kind.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
_FULL = "(?<=" + r"[0-9][ .()-]{0,2}" * 7 + ")"  # written out, as Java bounds no loop over a group
_OTHER = (
    "(?:" + "|".join((_EMAIL, _SECRET, _CARD, rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"))
    + f"|{_FULL}(?:{_SSN}|{_DATE}|{_IP}|(?<![0-9]){_LOCAL}))"
)
_PHONE = (
    r"(?<![0-9A-Za-z+])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?(?!" + _OTHER + r")[0-9]{2,4}){1,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|" + _LOCAL + r")(?![0-9])"
)
# Enough to tell a match of the phone pattern from other matches without its surroundings.
_PHONE_SHAPE = r"[+(][^@]*|" + _LOCAL
PATTERN = "|".join((_EMAIL, _SECRET, _IBAN, _SSN, _DATE, _IP, _PHONE, _CARD))
# Matches nothing itself, so values that start inside a match are listed as well.
STARTS = f"(?=({PATTERN}))"
# Every kind has one of these; most texts have none and are passed on at once.
HINT = r"[0-9][0-9.]|@|\([0-9]|[0-9a-fA-F]{32}"

# Characters of the IBANs of a country; others may have any length.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}
# Country calling codes of one or two digits; all others have three.
COUNTRY_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
# The column that holds the key while texts are replaced.
KEY = "_pseudonym_key"
CHUNK = 256  # candidates put in place at a time, so work grows with the text and not with its square

_DAYS = 146097  # of 400 years, 189 * 773
_FIRST_DAY = "date'1700-01-01'"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _noise(key: str, kind: str, *parts: str) -> str:
    return f"sha2(concat_ws('|', {key}, {_text(kind)}, {', '.join(parts)}), 256)"


def _shifted(text: str, noise: str, letters: int) -> str:
    """Every letter or digit moved within its class by the noise; others stay."""
    code, by = f"ascii(substr({text}, j, 1))", f"cast(conv(substr({noise}, 2 * j - 1, 2), 16, 10) AS int)"
    moved = (
        f"CASE WHEN {code} BETWEEN 48 AND 57 THEN char(pmod({code} - 48 + {by}, 10) + 48)"
        f" WHEN {code} BETWEEN 97 AND {96 + letters} THEN char(pmod({code} - 97 + {by}, {letters}) + 97)"
        f" WHEN {code} BETWEEN 65 AND {64 + letters} THEN char(pmod({code} - 65 + {by}, {letters}) + 65)"
        f" ELSE substr({text}, j, 1) END"
    )
    return f"if(length({text}) = 0, '', array_join(transform(sequence(1, length({text})), j -> {moved}), ''))"


def _permuted(text: str, key: str, kind: str, letters: int = 26) -> str:
    """A balanced Feistel network over the characters of ``text`` (up to 64)."""
    half = f"cast(length({text}) / 2 AS int)"
    start = f"named_struct('a', substr({text}, 1, {half}), 'b', substr({text}, {half} + 1))"
    noise = _noise(key, kind, f"cast(length({text}) AS string)", "cast(i AS string)", "s.b")
    step = f"named_struct('a', s.b, 'b', {_shifted('s.a', 'n', letters)})"
    # The noise is bound to a name once per round.
    step = f"transform(array({noise}), n -> {step})[0]"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (s, i) -> {step}, s -> concat(s.a, s.b))"


def _mixed(number: str, high: int, low: int, key: str, kind: str) -> str:
    """A Feistel network over the numbers below ``high * low``, halves by remainder."""

    def by(part: str, side: str) -> str:
        noise = _noise(key, kind, _text(side), "cast(i AS string)", f"cast({part} AS string)")
        return f"cast(conv(substr({noise}, 1, 12), 16, 10) AS bigint)"

    start = f"named_struct('x', cast(({number}) div {low} AS bigint), 'y', cast(({number}) % {low} AS bigint))"
    one = f"(s.x + {by('s.y', 'x')}) % {high}"
    step = f"transform(array({one}), x -> named_struct('x', x, 'y', (s.y + {by('x', 'y')}) % {low}))[0]"
    return f"aggregate(sequence(1, {ROUNDS // 2}), {start}, (s, i) -> {step}, s -> s.x * {low} + s.y)"


def _refilled(shape: str, payload: str, kept: str = "[^0-9]") -> str:
    """Characters of ``payload`` put in turn where ``shape`` does not match ``kept``."""
    put = (
        f"if(c rlike '{kept}', named_struct('out', concat(s.out, c), 'k', s.k),"
        f" named_struct('out', concat(s.out, substr(p, s.k, 1)), 'k', s.k + 1))"
    )
    return (
        f"transform(array({payload}), p -> aggregate(filter(split({shape}, ''), c -> c <> ''),"
        f" named_struct('out', '', 'k', 1), (s, c) -> {put}, s -> s.out))[0]"
    )


def _digits(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


def _luhn_sum(body: str) -> str:
    """Luhn sum of digits that a check digit follows."""
    digit = f"cast(substr({body}, j, 1) AS int)"
    double = f"pmod(length({body}) - j, 2) = 0"
    value = f"if({double}, if({digit} > 4, 2 * {digit} - 9, 2 * {digit}), {digit})"
    return f"aggregate(sequence(1, length({body})), 0, (s, j) -> s + {value})"


def _card(m: str, key: str) -> tuple[str, str]:
    digits = _digits(m)
    body = f"substr({digits}, 1, length({digits}) - 1)"
    valid = f"transform(array({body}), b -> pmod({_luhn_sum('b')} + cast(right({digits}, 1) AS int), 10) = 0)[0]"
    fresh = f"transform(array({_permuted(body, key, 'card')}), b -> concat(b, cast(pmod(10 - pmod({_luhn_sum('b')}, 10), 10) AS string)))[0]"
    return valid, _refilled(m, fresh)


def _remainder(text: str) -> str:
    """The text as digits (A is 10) modulo 97."""
    code = f"ascii(substr({text}, j, 1))"
    value = f"if({code} >= 65, (s * 100 + {code} - 55) % 97, (s * 10 + {code} - 48) % 97)"
    return f"aggregate(sequence(1, length({text})), 0, (s, j) -> {value})"


def _cuts(m: str, separators: str, valid) -> str:
    """The valid ones of ``m`` and its beginnings before a separator, longest first."""
    ends = f"filter(sequence(length({m}), 1, -1), e -> e = length({m}) OR substr({m}, e + 1, 1) rlike '[{separators}]')"
    return f"filter(transform({ends}, e -> substr({m}, 1, e)), v -> {valid('v')})"


def _whole_iban(m: str) -> str:
    """The part of ``m`` that is an IBAN, of the country's length if there is one; NULL if none."""
    plain = lambda v: f"replace({v}, ' ', '')"
    turned = lambda v: f"concat(substr({plain(v)}, 5), substr({plain(v)}, 1, 4))"
    cuts = _cuts(m, " ", lambda v: f"length({plain(v)}) >= 12 AND transform(array({turned(v)}), t -> {_remainder('t')} = 1)[0]")
    arms = " ".join(
        f"WHEN substr({m}, 1, 2) IN ({', '.join(map(_text, names.split()))}) THEN {length}" for length, names in IBAN_LENGTHS.items()
    )
    usual = f"filter(c, v -> length({plain('v')}) = CASE {arms} ELSE 0 END)"
    return f"transform(array({cuts}), c -> coalesce(try_element_at({usual}, 1), try_element_at(c, 1)))[0]"


def _whole_phone(m: str) -> str:
    return f"try_element_at({_cuts(m, ' .-', lambda v: f'length({_digits(v)}) BETWEEN 7 AND 15')}, 1)"


def _iban(m: str, key: str) -> tuple[str, str]:
    plain = f"replace({m}, ' ', '')"
    check = f"transform(array(concat(b, substr({m}, 1, 2), '00')), t -> lpad(cast(98 - {_remainder('t')} AS string), 2, '0'))[0]"
    body = _permuted(f"substr({plain}, 5)", key, "iban")
    fresh = f"transform(array({body}), b -> concat(substr({m}, 1, 2), {check}, b))[0]"
    return "true", _refilled(m, fresh, kept=" ")


def _ssn(m: str, key: str) -> tuple[str, str]:
    area, group, serial = (f"cast(substr({m}, {at}, {size}) AS bigint)" for at, size in ((1, 3), (5, 2), (8, 4)))
    valid = f"({area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0)"
    rank = f"(({area} - if({area} > 666, 2, 1)) * {99 * 9999} + ({group} - 1) * 9999 + {serial} - 1)"
    number = _mixed(rank, 898, 99 * 9999, key, "ssn")
    area = f"q div {99 * 9999} + if(q div {99 * 9999} >= 665, 2, 1)"
    shown = f"format_string('%03d-%02d-%04d', {area}, (q % {99 * 9999}) div 9999 + 1, q % 9999 + 1)"
    return valid, f"transform(array({number}), q -> {shown})[0]"


def _date(m: str, key: str) -> tuple[str, str]:
    iso = (
        f"CASE WHEN substr({m}, 5, 1) = '-' THEN {m}"
        f" WHEN substr({m}, 3, 1) = '.' THEN concat_ws('-', substr({m}, 7, 4), substr({m}, 4, 2), substr({m}, 1, 2))"
        f" ELSE concat_ws('-', substr({m}, 7, 4), substr({m}, 1, 2), substr({m}, 4, 2)) END"
    )
    day = f"try_cast({iso} AS date)"
    valid = f"coalesce(datediff({day}, {_FIRST_DAY}) BETWEEN 0 AND {_DAYS - 1}, false)"
    number = _mixed(f"datediff({day}, {_FIRST_DAY})", 189, 773, key, "date")
    shown = (
        f"CASE WHEN substr({m}, 5, 1) = '-' THEN t"
        f" WHEN substr({m}, 3, 1) = '.' THEN concat_ws('.', substr(t, 9, 2), substr(t, 6, 2), substr(t, 1, 4))"
        f" ELSE concat_ws('/', substr(t, 6, 2), substr(t, 9, 2), substr(t, 1, 4)) END"
    )
    return valid, f"transform(array(cast(date_add({_FIRST_DAY}, cast({number} AS int)) AS string)), t -> {shown})[0]"


def _ip(m: str, key: str) -> tuple[str, str]:
    part = [f"cast(substring_index(substring_index({m}, '.', {k}), '.', -1) AS bigint)" for k in (1, 2, 3, 4)]
    valid = "(" + " AND ".join(f"{p} <= 255" for p in part) + ")"
    number = _mixed(f"(({part[0]} * 256 + {part[1]}) * 256 + {part[2]}) * 256 + {part[3]}", 65536, 65536, key, "ip")
    shown = "concat_ws('.', q div 16777216, q div 65536 % 256, q div 256 % 256, q % 256)"
    return valid, f"transform(array({number}), q -> {shown})[0]"


def _phone(m: str, key: str) -> tuple[str, str]:
    head = f"regexp_extract({m}, '^[+](?:{COUNTRY_CODES}|[0-9]{{3}})', 0)"
    rest = f"substr({m}, length({head}) + 1)"
    fresh = _refilled(rest, _permuted(_digits(rest), key, "phone"))
    return "true", f"concat({head}, {fresh})"


def _email(m: str, key: str) -> tuple[str, str]:
    local = f"substring_index({m}, '@', 1)"
    return "true", f"concat({_permuted(local, key, 'email')}, substr({m}, length({local}) + 1))"


def _secret(m: str, key: str) -> tuple[str, str]:
    return "true", _permuted(m, key, "secret", letters=6)


def _whole(pattern: str) -> str:
    return _text("^(?:" + pattern + ")$")


def _replaced(m: str, key: str) -> str:
    """``(kind, value, size)`` for one match, ``size`` being the characters replaced; the kind is '' if it is not valid."""
    kept = "named_struct('kind', '', 'value', '', 'size', 0)"
    arms = []
    for kind, pattern, rule, part in (
        ("email", _EMAIL, _email, None), ("secret", _SECRET, _secret, None), ("iban", _IBAN, _iban, _whole_iban), ("ssn", _SSN, _ssn, None),
        ("date", _DATE, _date, None), ("ip", _IP, _ip, None), ("phone", _PHONE_SHAPE, _phone, _whole_phone), ("card", _CARD, _card, None),
    ):
        value = "w" if part else m
        valid, fresh = rule(value, key)
        put = f"named_struct('kind', '{kind}', 'value', {fresh}, 'size', length({value}))"
        if part:
            put = f"transform(array({part(m)}), w -> if(w IS NULL, {kept}, {put}))[0]"
        else:
            put = f"if({valid}, {put}, {kept})"
        arms.append(f"WHEN {m} rlike {_whole(pattern)} THEN {put}")
    return f"CASE {' '.join(arms)} ELSE {kept} END"


# Cells are the candidates with the text from their start to the next one's.
# ``skip`` is how much of the value before reaches into the next cell.
_PART = "struct<kind: string, text: string>"
_PLACED = f"""aggregate(
    transform(sequence(0, size(_cells) - 1, {CHUNK}), at -> slice(_cells, at + 1, {CHUNK})),
    named_struct('parts', cast(array() AS array<array<{_PART}>>), 'skip', 0),
    (done, chunk) -> transform(array(aggregate(
        chunk, named_struct('parts', cast(array() AS array<{_PART}>), 'skip', done.skip),
        (s, c) -> if(s.skip > 0 OR c.kind = '',
            named_struct(
                'parts', concat(s.parts, array(named_struct('kind', '', 'text', substr(c.text, s.skip + 1)))),
                'skip', greatest(s.skip - length(c.text), 0)),
            named_struct(
                'parts', concat(s.parts, array(named_struct('kind', c.kind, 'text', concat(c.value, substr(c.text, c.size + 1))))),
                'skip', greatest(c.size - length(c.text), 0)))
    )), s -> named_struct('parts', concat(done.parts, array(s.parts)), 'skip', s.skip))[0],
    done -> flatten(done.parts))"""


def pseudonymized(docs: DataFrame, key: str, *, text_col: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``; with ``counts``, also ``n_<kind>`` of what was replaced.

    The key is data of a one-row table, looked up by a scalar subquery, so it
    does not stand in the plan, the web page or the event log.
    """
    secret = docs.sparkSession.createDataFrame([(key,)], "secret string").select("secret")
    source = F.col(text_col).cast("string")
    found = F.when(source.rlike(HINT), F.regexp_extract_all(source, F.lit(STARTS), F.lit(1)))
    marked = docs.withColumn(KEY, secret.scalar()).withColumn("_found", F.when(F.size(found) > 0, found))
    # One piece per candidate, and one before the first unless the text starts with it.
    marked = marked.withColumn("_pieces", F.when(F.col("_found").isNotNull(), F.split(source, STARTS, -1)))
    cells = (
        f"zip_with(transform(_found, m -> {_replaced('m', KEY)}), slice(_pieces, size(_pieces) - size(_found) + 1, size(_found)),"
        " (x, p) -> named_struct('kind', x.kind, 'value', x.value, 'size', x.size, 'text', p))"
    )
    marked = marked.withColumn("_cells", F.expr(cells))
    marked = marked.withColumn("_fresh", F.expr(f"if(_cells IS NULL, NULL, {_PLACED})"))
    woven = F.expr("concat(if(size(_pieces) > size(_found), _pieces[0], ''), array_join(transform(_fresh, x -> x.text), ''))")
    out = marked.withColumn(text_col, F.when(F.col("_fresh").isNull(), source).otherwise(woven))
    if counts:
        for kind in KINDS:
            out = out.withColumn(f"n_{kind}", _count(kind))
    return out.drop(KEY, "_found", "_pieces", "_cells", "_fresh")


def _count(kind: str) -> Column:
    return F.coalesce(F.expr(f"size(filter(_fresh, x -> x.kind = '{kind}'))"), F.lit(0)).cast("long")
