"""Format-preserving pseudonyms for private values, by keyed Feistel permutations.

Found and validated: card numbers (Luhn), IBANs (mod 97), US social security numbers,
phone numbers, IPv4 addresses, calendar dates, e-mail addresses and secrets (keys by their
marks, and what is said to be a password, token or key). A value is read into one number
whatever its notation, within its format's domain, and a Feistel network under the key,
walked until it falls back into the domain, permutes that domain; the result is written in
the notation that was found. So a card stays a card with a right check digit, a date a
date, separators stay, equal values get equal pseudonyms in every document and every
notation, and no two values share one; with the key and the spans, unmask() goes back.

* Phones: the country code (from + or 00) and a trunk 0 stay; the national number is
  permuted among those of its length, so `+1 (375) 555-4393`, `+13755554393` and
  `(375) 555-4393` keep one number.
* Dates: year first, day first, month first or with an English month name, padded or not;
  a/b/year is read day first where both readings are dates. Days and months keep their
  count of digits, and a day over 12 stays over 12, so that all notations of a date go to
  all notations of another. Years of two digits are not taken for dates.
* E-mail: letters are permuted without regard to case, which stays; the domain stays.
* A match that does not validate is tried again with its last groups left off (a card
  before other digits, an IBAN before a word).

The key comes from the session's KEY_SETTING or is given; there is none in the code.

Defined cases: null text stays null, without spans; empty text stays; what looks alike but
does not validate stays; rows are handled one by one, so ties and repeats need no rule;
an empty table gives no rows; other columns stay. Whole texts are read.
"""

from __future__ import annotations

import calendar
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korvane.llm.common import Hidden, trim
from korvane.session import pick

#: The setting that holds the key of the permutations.
KEY_SETTING = "spark.korvane.pii.key"
ROUNDS = 8
YEARS = range(1900, 2100)
#: English month names; country calling codes of one and two digits (all others have three).
MONTHS = "January February March April May June July August September October November December".split()
CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()

_MONTH = "(?i:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + r")(?![a-z])\.?"
_DAY = r"\d{1,2}(?:st|nd|rd|th)?"
_FOUND = re.compile(
    r"(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
    r"|(?P<secret>\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{16,})\b)"
    r"|(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[ \t]*[=:][ \t]*[\"']?(?P<named>[^\s,;\"']{6,})"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<date>(?<![\w./-])(?:\d{4}(?P<s>[-/.])\d{1,2}(?P=s)\d{1,2}|\d{1,2}(?P<t>[-/.])\d{1,2}(?P=t)\d{4})(?![\d/-]|\.\d))"
    rf"|(?P<written>\b(?:{_DAY} {_MONTH},? \d{{4}}|{_MONTH} {_DAY},? \d{{4}})\b)"
    r"|(?P<ip>(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d.]*\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?(?:\(\d{2,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\.?\d)"
    r"|(?<![\w(])\(\d{3}\) ?\d{3}[-. ]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-]*\d)"
    r"|(?<![\w.,/+-])(?:\(0\d{1,4}\) ?|0\d{1,4}[ /-])\d{2,4}(?:[ -]?\d{2,4}){1,2}(?!\w|[.,/-]\d))"
    r"|(?P<card>(?<![\d.])\d(?:[ -]?\d){12,18}(?![\d]))"
)
#: What ends a group, and the kinds that are tried again without their last groups.
_GROUP = re.compile(r"(?<=[A-Z0-9])[ -]")
AGAIN = ("card", "iban")


def session_key(spark: SparkSession) -> str:
    """The key of the session; without one there are no pseudonyms."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"set {KEY_SETTING} to the key of the pseudonyms")
    return key


def feistel(x: int, size: int, key: str, kind: str, back: bool = False) -> int:
    """The keyed permutation of range(size) at x, or its inverse."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    rounds = range(ROUNDS)[:: -1 if back else 1]
    while True:
        a, b = x >> half, x & mask
        for r in rounds:
            h = hashlib.blake2b((a if back else b).to_bytes(width, "big"), digest_size=max(16, width), key=key.encode()[:64], person=hashlib.blake2b(f"{kind}:{r}:{half}".encode(), digest_size=16).digest())
            f = int.from_bytes(h.digest(), "big") & mask
            a, b = (b ^ f, a) if back else (b, a ^ f)
        x = (a << half) | b
        if x < size:
            return x


def _luhn(digits: str) -> int:
    """The check digit that digits need."""
    total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def _refill(shape: str, chars: str) -> str:
    """shape with its letters and digits replaced by chars, in order."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _classes(value: str, key: str, kind: str, back: bool, cased: bool = True) -> str:
    """Permutes ASCII letters and digits, each within its class, as one mixed-radix number; letters that are not cased are one class and keep their case."""
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    sets = [next((s for s in (digits, lower, upper) if c in s), c) for c in value]
    n, size = 0, 1
    for c, s in zip(value, sets, strict=True):
        n, size = n * len(s) + s.index(c), size * len(s)
    names = "".join("d" if s is digits else "a" if s is lower or not cased and s is upper else "A" if s is upper else s for s in sets)
    n = feistel(n, size, key, f"{kind}:{names}", back)
    out = []
    for s in reversed(sets):
        n, d = divmod(n, len(s))
        out.append(s[d])
    return "".join(reversed(out))


def _national(number: str, key: str, back: bool) -> str:
    """The pseudonym of a phone's national number, among those of its length that begin with 0 or do not, as it does."""
    n, low = len(number), 10 ** (len(number) - 1)
    if number[0] == "0":
        return str(feistel(int(number), low, key, f"phone0{n}", back)).zfill(n)
    return str(low + feistel(int(number) - low, 9 * low, key, f"phone{n}", back))


def _phone(value: str, key: str, back: bool) -> str | None:
    at = [i for i, c in enumerate(value) if c.isdigit()]
    if "(0)" in value:
        at.remove(value.index("(0)") + 1)
    digits, kept = "".join(value[i] for i in at), 0
    if value[0] == "+" or digits[:2] == "00":
        kept = 0 if value[0] == "+" else 2
        code = next((c for c in CODES if digits[kept:].startswith(c)), digits[kept : kept + 3])
        kept += len(code)
    elif digits[0] == "0":
        kept = 1
    number = digits[kept:]
    if not 7 <= len(number) <= 12 or not 8 <= len(digits) <= 15:
        return None
    out = list(value)
    for i, c in zip(at[kept:], _national(number, key, back), strict=True):
        out[i] = c
    return "".join(out)


def _spread(day: int, month: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """The days and months that a date's may go to: of as many digits, a day over 12 stays so, and May, which has no abbreviation, stays May."""
    days = next(x for x in (tuple(range(1, 10)), tuple(range(10, 13)), tuple(range(13, 32))) if day in x)
    return days, next(x for x in ((5,), (1, 2, 3, 4, 6, 7, 8, 9), (10, 11, 12)) if month in x)


def _date(year: int, month: int, day: int, key: str, back: bool) -> tuple[int, int, int] | None:
    """The pseudonym of a date; None where there is no such day."""
    if year not in YEARS or not 1 <= month <= 12 or not 1 <= day <= calendar.monthrange(year, month)[1]:
        return None
    days, months = _spread(day, month)
    n = ((year - YEARS[0]) * len(months) + months.index(month)) * len(days) + days.index(day)
    while True:  # walked until the day exists
        n = feistel(n, len(YEARS) * len(months) * len(days), key, f"date{days[0]}.{months[0]}", back)
        rest, d = divmod(n, len(days))
        y, m = divmod(rest, len(months))
        y, m, d = YEARS[y], months[m], days[d]
        if d <= calendar.monthrange(y, m)[1]:
            return y, m, d


def _numeric_date(value: str, key: str, back: bool) -> str | None:
    parts = re.split("([-/.])", value)
    a, b, c = map(int, parts[::2])
    if len(parts[0]) == 4:
        orders = [(0, 1, 2)]
    else:
        orders = [(2, 1, 0), (2, 0, 1)]  # places of year, month, day: day first, else month first
    for order in orders:
        new = _date(*((a, b, c)[i] for i in order), key, back)
        if new:
            for i, x in zip(order, new, strict=True):
                parts[2 * i] = str(x).zfill(len(parts[2 * i]))
            return "".join(parts)
    return None


def _written_date(value: str, key: str, back: bool) -> str | None:
    name = re.search("[A-Za-z]{3,}", value)
    short = name[0][:3].lower()
    month = next(i for i, m in enumerate(MONTHS, 1) if m[:3].lower() == short)
    numbers = list(re.finditer(r"(\d+)(st|nd|rd|th)?", value))
    year, day = numbers[1], numbers[0]
    new = _date(int(year[1]), month, int(day[1]), key, back)
    if not new:
        return None
    own = MONTHS[new[1] - 1] if len(name[0]) > 3 else MONTHS[new[1] - 1][:3]
    own = own.upper() if name[0].isupper() else own.lower() if name[0].islower() else own
    ends = {1: "st", 2: "nd", 3: "rd"}.get(new[2] % 10 if new[2] not in (11, 12, 13) else 0, "th")
    written = str(new[2]).zfill(len(day[1])) + (ends if day[2] else "")
    spots = sorted([(name.span(), own), (day.span(), written), (year.span(), str(new[0]))])
    out, at = [], 0
    for (a, b), x in spots:
        out += [value[at:a], x]
        at = b
    return "".join([*out, value[at:]])


def pseudonym(kind: str, value: str, key: str, back: bool = False) -> str | None:
    """The value's pseudonym (back: the value of a pseudonym), in its format; None if it does not validate."""
    if kind == "card":
        d = re.sub(r"\D", "", value)
        if not 13 <= len(d) <= 19 or len(set(d)) == 1 or int(d[-1]) != _luhn(d[:-1]):
            return None
        body = d[0] + str(feistel(int(d[1:-1]), 10 ** (len(d) - 2), key, f"card{len(d)}", back)).zfill(len(d) - 2)
        return _refill(value, body + str(_luhn(body)))
    if kind == "iban":
        d = value.replace(" ", "")
        number = lambda x: int("".join(str(int(c, 36)) for c in x))
        if not 15 <= len(d) <= 34 or number(d[4:] + d[:4]) % 97 != 1:
            return None
        body = _classes(d[4:], key, "iban", back)
        return _refill(value, d[:2] + f"{98 - number(body + d[:2] + '00') % 97:02d}" + body)
    if kind == "date":
        return (_written_date if any(map(str.isalpha, value)) else _numeric_date)(value, key, back)
    if kind == "phone":
        return _phone(value, key, back)
    if kind == "ip":
        octets = value.split(".")
        if any(int(o) > 255 or len(o) > 1 and o[0] == "0" for o in octets):
            return None
        n = feistel(int.from_bytes(bytes(map(int, octets)), "big"), 2**32, key, "ip", back)
        return ".".join(map(str, n.to_bytes(4, "big")))
    if kind == "ssn":
        a, g, s = map(int, value.split("-"))
        if a in (0, 666) or a > 899 or not g or not s:
            return None
        areas = [x for x in range(1, 900) if x != 666]
        n = feistel((areas.index(a) * 99 + g - 1) * 9999 + s - 1, len(areas) * 99 * 9999, key, "ssn", back)
        n, s = divmod(n, 9999)
        a, g = divmod(n, 99)
        return f"{areas[a]:03d}-{g + 1:02d}-{s + 1:04d}"
    if kind == "email":
        local, _, domain = value.rpartition("@")
        return f"{_classes(local, key, 'email', back, cased=False)}@{domain}"
    if re.fullmatch("[0-9a-f]{8,}", value):
        return f"{feistel(int(value, 16), 16 ** len(value), key, f'hex{len(value)}', back):0{len(value)}x}"
    fixed = re.match(r"AKIA|gh[pousr]_|sk-|", value)[0]  # the mark of its issuer is part of the format
    return fixed + _classes(value[len(fixed) :], key, "secret", back)


#: What a line must hold to have any private value.
_HINT = re.compile("[0-9@=:_]")


def mask(text: str, key: str, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and (start, end, kind) of each in it. No value goes over a line's end."""
    if not _HINT.search(text) and "AKIA" not in text and "sk-" not in text:
        return text, []
    out, spans, size = [], [], 0
    for line in text.splitlines(keepends=True):
        at = pos = 0
        hint = _HINT.search(line) or "AKIA" in line or "sk-" in line
        while hint and (m := _FOUND.search(line, pos)):
            kind, start, stop = m.lastgroup, *m.span(m.lastgroup)
            kind = "date" if kind == "written" else kind
            ends = [stop]
            if kind in AGAIN:
                ends += sorted((x.start() for x in _GROUP.finditer(line, start, stop)), reverse=True)
            for end in ends:
                if (new := pseudonym(kind, line[start:end], key, back)) is not None:
                    out += [line[at:start], new]
                    size += start - at
                    spans.append((size, size + len(new), kind))
                    size, at, pos = size + len(new), end, end
                    break
            else:  # the next match begins after the first run of letters or digits
                pos = _RUN.match(line, start).end()
        out.append(line[at:])
        size += len(line) - at
    return "".join(out), spans


_RUN = re.compile(r"\W*\w+|\W+")


def unmask(text: str, key: str, spans: list[tuple[int, int, str]] | None = None) -> str:
    """The text that mask() was given, exactly by the spans that it gave too; without them they are searched again, and a card or IBAN before other groups may be read with one more of these (where that validates by chance)."""
    if spans is None:
        return mask(text, key, back=True)[0]
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], pseudonym(kind, text[a:b], key, back=True)]
        at = b
    return "".join([*out, text[at:]])


def pseudonymise(docs: DataFrame, key: str | None = None) -> DataFrame:
    """docs with text masked and, after their own columns, private: (start, stop, kind) of every pseudonym."""
    own = Hidden(docs, "text")
    key = key or session_key(docs.sparkSession)

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            got = [mask(t.as_py(), key) if t.is_valid else (None, []) for t in texts]
            flat = [x for _, s in got for x in s]
            spans = [pa.array([x[0] for x in flat], pa.int32()), pa.array([x[1] for x in flat], pa.int32()), pa.array([x[2] for x in flat], pa.string())]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(s) for _, s in got)]), pa.int32()), pa.StructArray.from_arrays(spans, names=["start", "stop", "kind"]))
            yield pa.StructArray.from_arrays([pa.array([t for t, _ in got], pa.string()), lists], names=["text", "spans"])
        trim()

    each.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    out = own.df.withColumn("p_got", F.arrow_udf(each, "struct<text:string,spans:array<struct<start:int,stop:int,kind:string>>>")("text"))
    return own.shown(out.withColumn("private", F.col("p_got.spans")), "private", changed={"text": F.col("p_got.text")})


def pii_report(docs: DataFrame, key: str | None = None) -> DataFrame:
    """doc_id, text with pseudonyms, n_private, kinds."""
    got = pseudonymise(pick(docs, "doc_id", "text"), key)
    kinds = F.array_join(F.array_sort(F.transform("private", lambda s: s["kind"])), ",")
    return got.select("doc_id", "text", F.size("private").cast("long").alias("n_private"), kinds.alias("kinds"))
