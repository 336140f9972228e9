"""Format-preserving pseudonyms of personal numbers and dates by a keyed Feistel network.

Card numbers (Luhn), phone numbers, IPv4 and IPv6 addresses, IBANs (mod 97),
national identity numbers in the form 000-00-0000 and dates are found, validated,
and replaced by another value of the same format: a Feistel network over two
number halves permutes the values of the format under a key.  Values outside
the format's range are walked on (cycle walking), so the result is a
permutation: equal values get equal pseudonyms in every document, different
values different ones, and who has the key can undo it.  Separators, brackets,
country codes and check digits stay or are made anew, so a pseudonym passes the
same validation.  The local part of an e-mail address is permuted letter by
letter and digit by digit within its length; its domain stays.

What is permuted is the value, not how it is written, so one value gets one
pseudonym in all its forms: the national number of a phone (with or without its
country code, a bare ten-digit number counting as one of code 1, with or without
a trunk 0), the calendar day of a date (year first, dotted, with slashes, with an
English month name), the case-folded local part of an address, the compact IBAN
in either case, the number of an IPv6 address in long or short form.  Each is
written back in its own form.  Dates stay among days of as many digits and
months of as many (May, which has no short form, among those of May), and IPv6
groups keep their number of digits, so that every form can be written.  A date
with slashes whose day and month can be told apart is read so, else day first.

Forms are looked for one after the other, from the strictest to the loosest, in
what no earlier one took.  IBANs are cut to their country's length, phones with
a known country code to its number of digits; cards come in the usual groups
first.  Where a match fails validation, its shorter prefixes (in the loose
forms) and later starts within it are tried.  The strict forms are told by
shape, which a pseudonym keeps, so the way back finds them again; digit groups
that can be read as several card numbers in no usual grouping may be read
differently on the way back, as may phones of other countries before a number.

Defined cases: a null text stays null, an empty one empty; a null or repeated
id changes nothing (each text is treated alone); text outside the values found
is kept byte for byte; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import bisect
import datetime
import hmac
import ipaddress
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ids_and_texts, load

ROUNDS = 8
#: Dates are permuted among the days of these years.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
# FIXED VALUES: months of English dates.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def _day_class(day: datetime.date) -> str:
    """Digits of the day (those beyond the 12th apart: slashes) and of the month (May apart: no short name)."""
    return f"{(day.day > 9) + (day.day > 12)}{(day.month > 9) + 2 * (day.month == 5)}"


DAYS: dict[str, list[int]] = {}
for _day in range(FIRST_DAY, LAST_DAY + 1):
    DAYS.setdefault(_day_class(datetime.date.fromordinal(_day)), []).append(_day)

# FIXED VALUES: lengths of IBANs by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27,
    "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28,
    "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30}
# FIXED VALUES: digits of a national number, without a leading 0, by country code.
PHONE_LENGTH = {"1": 10, "7": 10, "27": 9, "30": 10, "31": 9, "33": 9, "34": 9, "40": 9, "41": 9, "44": 10, "45": 8, "47": 8, "48": 9, "52": 10, "56": 9, "57": 10,
                "61": 9, "63": 10, "65": 8, "90": 10, "91": 10, "92": 10, "351": 9, "420": 9, "852": 8}
KNOWN_CODE = re.compile(r"\+(" + "|".join(PHONE_LENGTH) + ")")
PATTERNS = {
    "email": r"(?<![\w.+-])(?P<email>[A-Za-z0-9][A-Za-z0-9._+-]*)(?=@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)",
    "iban": r"(?<![A-Za-z0-9])(?P<iban>[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,29})(?![A-Za-z0-9])",
    "ipv6": r"(?<![0-9A-Za-z:.])(?P<ipv6>(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4})(?![0-9A-Za-z:.])",
    "ip": r"(?<![0-9.])(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?P<date>[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9]|-[0-9])",
    "card": r"(?<![0-9])(?P<card>[0-9](?:[ -]?[0-9]){12,18})(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?P<phone>\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4})(?![0-9])",
}
_MONTH = "(?:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + ")"
#: Dates with a month's name, and phones of ten digits with neither code nor brackets.
WRITTEN_DATE = rf"(?i)(?<![0-9A-Za-z])(?:[0-9]{{1,2}} {_MONTH}|{_MONTH} [0-9]{{1,2}},?) [0-9]{{4}}(?![0-9A-Za-z])"
BARE_PHONE = r"(?<![0-9A-Za-z.+-])[2-9][0-9]{2}([.-])[2-9][0-9]{2}\1[0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"
#: Cards without separators or in the usual groups (4-4-4-4, 4-6-5, 4-6-4).
USUAL_CARD = r"(?<![0-9+])(?:[0-9]{13,19}|[2-6][0-9]{3}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[0-9]{3}([ -])[0-9]{6}\2[0-9]{4,5})(?![0-9])"
#: No value is without one of these; a look for them spares most texts the patterns.
HINT = re.compile("[0-9@]|::|:[0-9A-Fa-f]+:")
KINDS = tuple(PATTERNS)


def _mask(key: bytes, message: str, wide: int) -> int:
    """A keyed pseudorandom number of ``wide`` bytes."""
    out = hmac.digest(key, message.encode(), "sha256")
    block = 0
    while len(out) < wide:
        block += 1
        out += hmac.digest(key, f"{message}|{block}".encode(), "sha256")
    return int.from_bytes(out[:wide], "big")


def feistel(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A permutation of 0 .. size-1 by key and format (``tweak``): balanced Feistel rounds over a square, walked back into range."""
    if size < 2:
        return value
    side = math.isqrt(size - 1) + 1
    wide = max(16, side.bit_length() // 8 + 9)  # bytes: eight more than a half has, so no remainder is favoured
    rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    while True:
        left, right = divmod(value, side)
        for r in rounds:
            half = left if back else right
            mixed = _mask(key, f"{tweak}|{size}|{r}|{half}", wide) % side
            left, right = ((right - mixed) % side, left) if back else (right, (left + mixed) % side)
        value = left * side + right
        if value < size:
            return value


def luhn_digit(digits: str) -> str:
    """The check digit that completes a number."""
    total = sum((2 * int(d) - 9 * (int(d) > 4)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _refill(shape: str, chars: str) -> str:
    """``shape`` with its letters and digits replaced in order."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _digits(s: str, key: bytes, tweak: str, back: bool) -> str:
    return str(feistel(int(s), 10 ** len(s), key, f"{tweak}{len(s)}", back)).zfill(len(s)) if s else s


def _card(s, key, back):
    d = re.sub("[ -]", "", s)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    body = d[0] + _digits(d[1:-1], key, f"card{d[0]}", back)  # the first digit names the network
    return _refill(s, body + luhn_digit(body))


def _iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def _iban(s, key, back):
    flat = s.replace(" ", "").upper()
    country, rest = flat[:2], flat[4:]
    if IBAN_LENGTH.get(country) != len(flat) or _iban_check(country, rest) != flat[2:4]:
        return None
    digits = "".join(c for c in rest if c.isdigit())
    it = iter(_digits(digits, key, f"iban{country}", back))
    rest = "".join(next(it) if c.isdigit() else c for c in rest)
    new = _refill(s, country + _iban_check(country, rest) + rest)
    return "".join(n.lower() if c.islower() else n for n, c in zip(new, s, strict=True))  # letters stay, in their case


def _ipv6(s, key, back):
    try:
        groups = [int(g, 16) for g in ipaddress.IPv6Address(s).exploded.split(":")]
    except ValueError:
        return None
    if sum(len(f"{g:x}") for g in groups if g) < 5:  # as much ``a::b`` of a program, or the machine itself
        return None
    # Each group keeps its number of digits: a mixed number with one place for each.
    low = [16 ** (len(f"{g:x}") - 1) if g else 0 for g in groups]
    sizes = [16 ** len(f"{g:x}") - n if g else 1 for g, n in zip(groups, low, strict=True)]
    at = 0
    for g, n, k in zip(groups, low, sizes, strict=True):
        at = at * k + g - n
    at, new = feistel(at, math.prod(sizes), key, "ipv6" + "".join(str(len(f"{g:x}") if g else 0) for g in groups), back), []
    for n, k in zip(reversed(low), reversed(sizes), strict=True):
        at, g = divmod(at, k)
        new.append(g + n)
    # Groups that are written (all others are zeros under ``::``) in their width and case.
    parts = s.split(":")
    written = [i for i, part in enumerate(parts) if part]
    before = len([x for x in s.split("::")[0].split(":") if x]) if "::" in s else len(parts)
    new = list(reversed(new))
    values = new[:before] + (new[8 - (len(written) - before):] if len(written) > before else [])
    for i, v in zip(written, values, strict=True):
        text = f"{v:x}".zfill(len(parts[i]))
        parts[i] = text.upper() if any(c in "ABCDEF" for c in s) else text
    return ":".join(parts)


def _ip(s, key, back):
    parts = s.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    n = feistel(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ip", back)
    return ".".join(str(b) for b in n.to_bytes(4, "big"))


def _date(s, key, back):
    parts = re.findall(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]+", s)
    where = [i for i, part in enumerate(parts) if part.isalnum()]
    named = next((i for i in where if parts[i].isalpha()), None)
    if len(where) != 3:
        return None
    orders = ["dmy" if named == where[1] else "mdy"] if named is not None else ["ymd"] if len(parts[where[0]]) == 4 else ["dmy", "mdy"] if "/" in s else ["dmy"]
    for order in orders:
        at = dict(zip(order, where, strict=True))
        number = {k: int(parts[i]) if i != named else next((n for n, m in enumerate(MONTHS, 1) if parts[i].lower() in (m.lower(), m[:3].lower())), 0) for k, i in at.items()}
        try:
            day = datetime.date(number["y"], number["m"], number["d"])
        except ValueError:
            continue
        kind = _day_class(day)
        if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
            continue
        days = DAYS[kind]
        new = datetime.date.fromordinal(days[feistel(bisect.bisect_left(days, day.toordinal()), len(days), key, f"date{kind}", back)])
        for k, v in (("y", new.year), ("m", new.month), ("d", new.day)):
            old = parts[at[k]]
            if at[k] == named:
                name = MONTHS[v - 1] if len(old) > 3 or v == 5 else MONTHS[v - 1][:3]
                parts[at[k]] = name.upper() if old.isupper() else name.lower() if old.islower() else name
            else:
                parts[at[k]] = f"{v:0{len(old)}d}"
        return "".join(parts)
    return None


def _ssn(s, key, back):
    area, group, serial = map(int, s.split("-"))
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    at = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    at = feistel(at, 898 * 99 * 9999, key, "ssn", back)
    area, rest = divmod(at, 99 * 9999)
    area += 1 + (area >= 665)
    return f"{area:03d}-{rest // 9999 + 1:02d}-{rest % 9999 + 1:04d}"


def _nanp(d: str) -> bool:
    """Whether ten digits are a number of country code 1."""
    return len(d) == 10 and d[0] > "1" and d[3] > "1"


def _national(d: str, code: str, key: bytes, back: bool) -> str:
    """The pseudonym of a national number."""
    if code == "1" and _nanp(d):
        at = ((int(d[:3]) - 200) * 800 + int(d[3:6]) - 200) * 10_000 + int(d[6:])
        at, line = divmod(feistel(at, 800 * 800 * 10_000, key, "phone1", back), 10_000)
        return f"{at // 800 + 200}{at % 800 + 200}{line:04d}"
    # It keeps whether it starts with 0 or 1, which no area does.
    lead = d[0] if d[0] in "01" else ""
    while True:
        rest = d[len(lead):]
        if lead:
            d = lead + _digits(rest, key, f"phone{code}{lead}", back)
        else:
            least = 2 * 10 ** (len(rest) - 1)
            d = str(feistel(int(rest) - least, 4 * least, key, f"phone{code}", back) + least)
        if code != "1" or not _nanp(d):  # walked on within the numbers that are none of code 1
            return d


def _phone(s, key, back):
    code = KNOWN_CODE.match(s) or re.match(r"\+[0-9]{1,3}(?![0-9])", s)
    head = code[0] if code else ""
    d = re.sub("[^0-9]", "", s[len(head):])
    if not 7 <= len(re.sub("[^0-9]", "", s)) <= 15 or len(d) < 5:
        return None
    country = head[1:] or "1"
    trunk = "0" if head and d[0] == "0" and len(d) == PHONE_LENGTH.get(country, 0) + 1 else ""
    it = iter(trunk + _national(d[len(trunk):], country, key, back))
    return head + "".join(next(it) if c.isdigit() else c for c in s[len(head):])


def _email(s, key, back):
    form = "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in s)
    sizes = [10 if c == "9" else 26 for c in form if c in "9a"]
    at = 0
    for c, k in zip((c.lower() for c in s if c.isalnum()), sizes, strict=True):
        at = at * k + (int(c) if k == 10 else ord(c) - 97)
    at, out = feistel(at, math.prod(sizes), key, f"email{form}", back), []
    for k in reversed(sizes):
        at, c = divmod(at, k)
        out.append(str(c) if k == 10 else chr(97 + c))
    it = reversed(out)
    return "".join((next(it).upper() if c.isupper() else next(it)) if c.isalnum() else c for c in s)


BY_KIND = {"email": _email, "iban": _iban, "ipv6": _ipv6, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def pseudonym(kind: str, value: str, key: bytes, back: bool = False) -> str | None:
    """The pseudonym of a value, or with ``back`` the value of a pseudonym; None if it does not pass the format's validation."""
    return BY_KIND[kind](value, key, back)


def _whole(m: re.Match) -> list[int]:
    return [m.end()]


def _by_country(m: re.Match) -> list[int]:
    """Where an IBAN ends by its country's length."""
    n = IBAN_LENGTH.get(m[0][:2].upper(), 99)
    ends = [m.start() + i + 1 for i, c in enumerate(m[0]) if c != " "]
    return [ends[n - 1]] if len(ends) >= n and not m.string[ends[n - 1]:ends[n - 1] + 1].isalnum() else []


def _by_code(m: re.Match) -> list[int]:
    """Where a phone ends by its country code's number of digits (at its own end without a country code)."""
    code = KNOWN_CODE.match(m[0])
    if not code:
        return [] if m[0][0] == "+" else [m.end()]
    ends = [m.start() + i + 1 for i, c in enumerate(m[0]) if i >= code.end() and c.isdigit()]
    n = PHONE_LENGTH[code[1]]
    n += bool(ends) and m.string[ends[0] - 1] == "0"
    return [ends[n - 1]] if len(ends) >= n and not m.string[ends[n - 1]:ends[n - 1] + 1].isdigit() else []


def _shorter(m: re.Match) -> list[int]:
    """The match's end and those of its shorter prefixes that end with a digit group."""
    ends = [i for i in range(m.end() - 1, m.start() + 6, -1) if m.string[i - 1].isdigit() and not m.string[i].isdigit()]
    return [m.end()] + [i for i in ends if m.re.fullmatch(m.string, m.start(), i)]


#: Kind, form, where a match may end, and a character without which there is none.
PASSES = [(kind, re.compile(form), ends, hint) for kind, form, ends, hint in (
    ("email", PATTERNS["email"], _whole, "@"), ("iban", PATTERNS["iban"], _by_country, ""), ("ipv6", PATTERNS["ipv6"], _whole, ":"), ("phone", PATTERNS["phone"], _by_code, ""), ("phone", BARE_PHONE, _whole, ""),
    ("date", WRITTEN_DATE, _whole, ""), ("ip", PATTERNS["ip"], _whole, "."),
    ("date", PATTERNS["date"], _whole, ""), ("ssn", PATTERNS["ssn"], _whole, "-"), ("card", USUAL_CARD, _whole, ""), ("phone", PATTERNS["phone"], _shorter, "+"), ("card", PATTERNS["card"], _shorter, ""))]


def replaced(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with valid values replaced, and how many of each kind."""
    counts: dict[str, int] = {}
    if not HINT.search(text):
        return text, counts
    rest, found = text, []  # what is taken is blanked in ``rest``
    for kind, form, ends, hint in PASSES:
        if hint not in rest:
            continue
        at, taken = 0, []
        while m := form.search(rest, at):
            at = m.start() + 1
            for end in ends(m):
                new = pseudonym(kind, text[m.start():end], key, back)
                if new is not None:
                    taken.append((m.start(), end, new))
                    at = end
                    break
        if taken:
            counts[kind] = counts.get(kind, 0) + len(taken)
            found += taken
            rest = _put(rest, [(a, b, "\0" * (b - a)) for a, b, _ in taken])
    return _put(text, sorted(found)), counts


def _put(text: str, parts: list[tuple[int, int, str]]) -> str:
    """The text with the spans ``parts``, in order, replaced."""
    out, at = [], 0
    for a, b, new in parts:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]])


def pseudonymised(df: DataFrame, key: bytes, back: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text (pseudonymised), n_replaced, and n_<kind> for each kind.  A map over rows: nothing is shuffled."""
    docs = ids_and_texts(df, id_col, text_col)

    def run(batches):
        for batch in batches:
            texts, counts = [], []
            for text in batch.column("text").to_pylist():
                new, found = (None, {}) if text is None else replaced(text, key, back)
                texts.append(new), counts.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array([sum(c.values()) for c in counts], pa.int64()),
                 *(pa.array([c.get(k, 0) for c in counts], pa.int64()) for k in KINDS)], ["doc_id", "text", "n_replaced", *(f"n_{k}" for k in KINDS)])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, n_replaced long, " + ", ".join(f"n_{k} long" for k in KINDS)
    return docs.mapInArrow(run, schema)


#: Of the registered query alone, so that its reruns agree; whoever pseudonymises texts has a secret key of their own.
QUERY_KEY = b"ledgerline registered query"


def op7_pii_pseudonyms(spark, sf_dir: str) -> DataFrame:
    rows = pseudonymised(load(spark, sf_dir, "documents"), QUERY_KEY)
    return rows.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
