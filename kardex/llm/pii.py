"""Format-preserving Feistel pseudonyms for personal data in text.

A found value is validated (check digits, calendar, octets), mapped to a number
below the size of its format, permuted by a keyed Feistel network and written
back in the same format.  The permutation depends on the key, the kind and the
normalised value only: equal values get equal pseudonyms in every document, and
``reverse`` undoes them.  A candidate that fails its validation stays.

Cards, IBANs and phones beside other numbers or words have several readings,
which start and end where groups do; the best valid ones that do not overlap
are taken.  A pseudonym by which the text would be read otherwise is walked
past, so that ``reverse`` finds the same places; only there does a pseudonym
depend on its neighbours, too.  A short number behind a ``+`` phone of another
country than +1 may be read as its end, as nothing tells them apart.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import field, memory_given_back, parts_by_bytes, without

ROUNDS = 10


class Feistel:
    """A keyed permutation of range(size), by an alternating Feistel network
    over a grid of at least ``size`` cells, walking on while outside."""

    def __init__(self, key: bytes, label: str, size: int):
        self.size = size
        self.rows = max(1, int(size ** 0.5))
        while self.rows * self.rows < size:
            self.rows += 1
        self.columns = -(-size // self.rows)
        self.seed = hashlib.blake2b(f"{label}/{size}".encode(), key=key[:64], digest_size=32).digest()

    def _mix(self, turn: int, half: int) -> int:
        data = turn.to_bytes(2, "big") + half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.seed, digest_size=24).digest(), "big")

    def _once(self, value: int, turns: range, sign: int) -> int:
        left, right = divmod(value, self.columns)
        for turn in turns:
            if turn % 2:
                right = (right + sign * self._mix(turn, left)) % self.columns
            else:
                left = (left + sign * self._mix(turn, right)) % self.rows
        return left * self.columns + right

    def walk(self, value: int, keep: Callable[[int], bool], back: bool = False) -> int:
        turns, sign = (range(ROUNDS - 1, -1, -1), -1) if back else (range(ROUNDS), 1)
        while True:
            value = self._once(value, turns, sign)
            if value < self.size and keep(value):
                return value

    def apply(self, value: int, back: bool = False) -> int:
        return self.walk(value, lambda _: True, back)


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_rest(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def nanp(digits: str) -> bool:
    """A ten-digit number of the North American plan."""
    return digits[0] > "1" and digits[3] > "1"


def card_digits(text: str) -> str | None:
    value = re.sub(r"[ -]", "", text)
    valid = 13 <= len(value) <= 19 and luhn_digit(value[:-1]) == value[-1] and len(set(value)) > 1
    return value if valid else None


def iban_value(text: str) -> str | None:
    value = text.replace(" ", "")
    return value if 15 <= len(value) <= 34 and iban_rest(value) == 1 else None


#: National forms: pattern, digits that stay, country of the plan they share
#: with the international form (0: not known).
_NATIONAL = {
    "fr": (r"0[1-9](?:([ .-])[0-9]{2})(?:\1[0-9]{2}){3}|0[1-9][0-9]{8}", 1, "33"),
    "es": (r"[6-9][0-9]{2}([ .-])[0-9]{2}\1[0-9]{2}\1[0-9]{2}", 0, "34"),
    "trunk": (r"\(?0[1-9][0-9]{1,4}(?:\) ?| |/)[0-9]{3,8}(?: [0-9]{3,4})?", 1, "0"),
}
_NATIONAL_RULES = [(re.compile(pattern), *rest) for pattern, *rest in _NATIONAL.values()]


def phone_parts(text: str) -> tuple[str, str, str] | None:
    """Digits that stay, the rest, and the numbering plan."""
    value = re.sub(r"\D", "", text)
    if text.startswith("+1") and len(value) == 11:
        return "1", value[1:], "1"
    if text.startswith("+"):
        return (value[:2], value[2:], value[:2]) if 8 <= len(value) <= 15 else None
    for pattern, stay, plan in _NATIONAL_RULES:
        if pattern.fullmatch(text) and 9 <= len(value) <= 12:
            return value[:stay], value[stay:], plan
    return ("", value, "1") if len(value) == 10 and nanp(value) else None


def _first_digit(plan: str, rest: str) -> bool:
    """What a number's first digit says about its form; pseudonyms say the same."""
    return rest[0] > "5" if plan == "34" else rest[0] != "0"


def refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced, in order."""
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in shape)


class Pseudonyms:
    """The permutations of one key; each method maps a match to its
    replacement or None if the value is not valid."""

    def __init__(self, key: bytes, back: bool = False):
        self.back = back
        self.network = lru_cache(4096)(lambda label, size: Feistel(key, label, size))

    def digits(self, label: str, value: str, keep: Callable[[str], bool] = lambda _: True) -> str:
        n = len(value)
        net = self.network(f"{label}/{n}", 10 ** n)
        return str(net.walk(int(value), lambda x: keep(str(x).zfill(n)), self.back)).zfill(n)

    def card(self, text: str, keep: Callable[[str], bool] = lambda _: True) -> str | None:
        value = card_digits(text)
        if value is None:
            return None

        def whole(inner: str) -> str:
            # First digit (the network) stays; the last is the check digit.
            return refill(text, value[0] + inner + luhn_digit(value[0] + inner))

        return whole(self.digits(f"card{value[0]}", value[1:-1], lambda x: keep(whole(x))))

    def phone(self, text: str, keep: Callable[[str], bool] = lambda _: True) -> str | None:
        parts = phone_parts(text)
        if parts is None:
            return None
        stay, rest, plan = parts
        form = nanp if len(rest) == 10 and plan == "1" else lambda x: _first_digit(plan, x)
        rest = self.digits(f"phone{plan}", rest, lambda x, of=form(rest): form(x) == of and keep(refill(text, stay + x)))
        return refill(text, stay + rest)

    def ssn(self, text: str) -> str | None:
        def valid(v: str) -> bool:
            return v[:3] not in ("000", "666") and v[0] != "9" and v[3:5] != "00" and v[5:] != "0000"

        value = text.replace("-", "")
        return refill(text, self.digits("ssn", value, valid)) if valid(value) else None

    def address(self, text: str) -> str | None:
        octets = [int(x) for x in text.split(".")]
        if max(octets) > 255:
            return None
        value = self.network("ipv4", 1 << 32).apply(int.from_bytes(bytes(octets), "big"), self.back)
        return ".".join(map(str, value.to_bytes(4, "big")))

    def iban(self, text: str, keep: Callable[[str], bool] = lambda _: True) -> str | None:
        value = iban_value(text)
        if value is None:
            return None

        def whole(digits: str) -> str:
            body = refill(value[4:], digits)
            check = 98 - iban_rest(value[:2] + "00" + body)
            it = iter(f"{value[:2]}{check:02d}{body}")
            return "".join(c if c == " " else next(it) for c in text)

        return whole(self.digits(f"iban{value[:2]}", "".join(c for c in value[4:] if c.isdigit()), lambda x: keep(whole(x))))

    def date(self, text: str) -> str | None:
        a, b, c = re.split(r"[-/.]", text)
        if len(a) == 4:
            order = "ymd"
        elif int(a) > 12 or "." in text:
            order = "dmy"
        else:
            order = "mdy"
        try:
            found = dict(zip(order, (int(a), int(b), int(c))))
            day = datetime.date(found["y"], found["m"], found["d"])
        except ValueError:
            return None
        first, last = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
        if not first <= day.toordinal() <= last:
            return None

        def same(value: int) -> bool:
            # Month-first and day-first readings must not change places.
            return order != "dmy" or "." in text or datetime.date.fromordinal(first + value).day > 12

        label = "date/late" if order == "dmy" and "." not in text else "date"
        new = datetime.date.fromordinal(first + self.network(label, last - first + 1).walk(
            day.toordinal() - first, same, self.back))
        parts = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        marks = [x for x in text if x in "-/."]
        return parts[order[0]] + marks[0] + parts[order[1]] + marks[1] + parts[order[2]]

    def email(self, text: str) -> str | None:
        local, _, domain = text.rpartition("@")
        value = size = 0
        for c in local:
            radix, digit = _cell(c)
            value, size = value * radix + digit, (size or 1) * radix
        if size < 2:
            return None
        shape = "".join("9" if c.isdigit() else "a" if _cell(c)[0] == 26 else c for c in local)
        value = self.network(f"email/{shape}@{domain.lower()}", size).apply(value, self.back)
        out = []
        for c in reversed(local):
            radix, _ = _cell(c)
            value, digit = divmod(value, radix)
            out.append(c if radix == 1 else str(digit) if radix == 10 else chr((65 if c.isupper() else 97) + digit))
        return "".join(reversed(out)) + "@" + domain

    def hex(self, text: str) -> str | None:
        value = self.network(f"hex/{len(text)}", 16 ** len(text)).apply(int(text, 16), self.back)
        out = f"{value:0{len(text)}x}"
        return out.upper() if text.upper() == text else out


def _cell(c: str) -> tuple[int, int]:
    if "0" <= c <= "9":
        return 10, ord(c) - 48
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return 26, ord(c.lower()) - 97
    return 1, 0


_KINDS = {
    "email": r"(?<![\w.+%-])[\w.+%-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "hex": r"(?<![0-9A-Za-z])(?=[0-9]*[A-Fa-f])(?:[0-9a-f]{64}|[0-9A-F]{64}|[0-9a-f]{40}|[0-9A-F]{40}|[0-9a-f]{32}|[0-9A-F]{32})(?![0-9A-Za-z])",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\2[0-9]{4})(?![0-9A-Za-z]|[./-][0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "address": r"(?<![0-9A-Za-z.])(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}(?![0-9A-Za-z]|\.[0-9])",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){1,5}"
             r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|"
             + "|".join(f"(?:{pattern})".replace("\\1", f"(?P={name})").replace("([ .-])", f"(?P<{name}>[ .-])", 1)
                        for name, (pattern, *_) in _NATIONAL.items()),
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
}
KINDS = tuple(_KINDS)


#: Group sizes in which cards are printed; these readings go first.
_LAYOUTS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 5), (4, 4, 4, 4, 3)}
_DIGITS = re.compile(r"[0-9]+")
_CARD_RUN = re.compile(r"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){12})[0-9]+(?:[ -][0-9]+)*(?![0-9A-Za-z])")
_IBAN_RUN = re.compile(r"(?<![0-9A-Za-z])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){8,31}))")
_PHONE_RUN = re.compile(
    r"(?<![0-9A-Za-z+])(?=(\+[0-9]+(?:[ .()-]{1,3}[0-9]+){0,8}|\(?[0-9]{3}(?:\) ?|[ .-])[0-9]{3}[ .-][0-9]{4}"
    # Without a country code, groups are a number only where their row does not go on.
    r"|(?<![0-9][ ./-])(?:(?:0[1-9]|[6-9][0-9]{2})(?:[ .-][0-9]{2}){3,4}|0[1-9][0-9]{8}"
    r"|\(?0[1-9][0-9]{1,4}(?:\) ?| |/)[0-9]{3,8}(?: [0-9]{3,4})?)(?![ ./-]?[0-9])))")
#: Digits of a whole number by the plan's country code.
_PHONE_SIZE = {"+1": 11, "+33": 11, "+34": 11, "+44": 12}
#: Characters of an IBAN by country; readings of that length go first.
_IBAN_SIZE = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC"}.items() for c in cs.split()}
#: (rank, start, end): the lower rank is taken.
Reading = tuple[tuple, int, int]


def _card_readings(text: str) -> Iterator[Reading]:
    for run in _CARD_RUN.finditer(text):
        groups = [m.span() for m in _DIGITS.finditer(text, *run.span())]
        for i, (start, _) in enumerate(groups):
            sizes: list[int] = []
            for s, e in groups[i:i + 19]:
                sizes.append(e - s)
                if sum(sizes) > 19:
                    break
                if sum(sizes) >= 13:
                    yield (len(sizes) > 1 and tuple(sizes) not in _LAYOUTS, -sum(sizes), start), start, e


def _prefixes(run: re.Pattern, whole: re.Pattern) -> Callable[[str], Iterator[Reading]]:
    """Readings from each start of ``run``, to the end of any of its groups."""
    def readings(text: str) -> Iterator[Reading]:
        for m in run.finditer(text):
            for end in range(m.end(1), m.start() + 7, -1):
                if not text[end:end + 1].isalnum() and text[end - 1].isalnum() and whole.fullmatch(text, m.start(), end):
                    # The country's own length goes first, then the longest.
                    size = _PHONE_SIZE.get(m[1][:2]) or _PHONE_SIZE.get(m[1][:3]) or _IBAN_SIZE.get(m[1][:2])
                    own = sum(map(str.isalnum, text[m.start():end])) == size
                    yield (m.start(), not own, -end), m.start(), end

    return readings


#: Kinds whose values may have other numbers or words beside them.
_READINGS = {
    "iban": (_prefixes(_IBAN_RUN, re.compile(_KINDS["iban"])), iban_value),
    "phone": (_prefixes(_PHONE_RUN, re.compile(_KINDS["phone"])), phone_parts),
    "card": (_card_readings, card_digits),
}


class _Places:
    """Spans ``(..., start, end)`` by place."""

    def __init__(self, spans: list[tuple]):
        self.spans = sorted(spans, key=lambda x: x[1:3])
        self.starts = [x[1] for x in self.spans]
        self.longest = max((x[2] - x[1] for x in spans), default=0)

    def meeting(self, start: int, end: int) -> list[tuple]:
        near = self.spans[bisect_left(self.starts, start - self.longest):bisect_left(self.starts, end)]
        return [x for x in near if start < x[2]]


def _read(text: str, readings: list[Reading], valid: Callable[[str], object], method, back: bool,
          failed: list[tuple]) -> list[tuple[int, int, str]]:
    """Replacements of the valid readings that no better one overlaps.
    ``failed`` has ``(valid, start, end)`` of what was read before and was not
    valid; what fails here is added."""
    if not readings:
        return []
    taken, used = [], bytearray(len(text))
    for r in sorted(r for r in readings if valid(text[r[1]:r[2]]) is not None):
        if not any(used[r[1]:r[2]]):
            used[r[1]:r[2]] = b"\1" * (r[2] - r[1])
            taken.append(r)
    places = _Places(taken)
    # Had one of these been valid, it would have taken a place.
    open_ = [r for r in readings if not any(x[0] <= r[0] for x in places.meeting(r[1], r[2]))]
    better, before = _Places(open_), _Places([x for x in failed if "z" not in text[x[1]:x[2]]])
    out, now = [], list(text) if taken else []
    for t in places.spans[::-1 if back else 1]:
        rivals = [(valid, *r[1:]) for r in better.meeting(t[1], t[2]) if r[0] < t[0]] + before.meeting(t[1], t[2])

        def keep(new: str, t=t, rivals=rivals) -> bool:
            now[t[1]:t[2]] = new
            return all(ok("".join(now[s:e])) is None for ok, s, e in rivals)

        new = method(text[t[1]:t[2]], keep)
        now[t[1]:t[2]] = new
        out.append((t[1], t[2], new))
    failed += [(valid, *r[1:]) for r in open_ if not any(used[r[1]:r[2]])]
    return out


def replacer(key: bytes, kinds: tuple[str, ...] = KINDS, back: bool = False):
    """text -> (text with pseudonyms, number of values replaced)."""
    names = Pseudonyms(key, back)
    rules = [(k, re.compile(_KINDS[k]), getattr(names, k)) for k in kinds]
    hint, mails = re.compile(r"[0-9]"), "email" in kinds

    def replace(text: str) -> tuple[str, int]:
        if not hint.search(text) and not (mails and "@" in text):
            return text, 0
        # Kinds in order; text that one has replaced is not looked at again.
        done: list[tuple[int, int, str]] = []
        left, failed = text, []
        for kind, pattern, method in rules:
            if kind in _READINGS:
                readings, valid = _READINGS[kind]
                found = _read(left, list(readings(left)), valid, method, back, failed)
            else:
                got = [(m.start(), m.end(), method(m[0])) for m in pattern.finditer(left)]
                found = [x for x in got if x[2] is not None]
                failed += [(method, *x[:2]) for x in got if x[2] is None]
            if found:
                done += found
                parts, at = [], 0
                for start, end, _ in sorted(found):
                    parts += [left[at:start], re.sub(r"[0-9A-Za-z]", "z", left[start:end])]
                    at = end
                left = "".join(parts) + left[at:]
        out, at = [], 0
        for start, end, new in sorted(done):
            out += [text[at:start], new]
            at = end
        return "".join(out) + text[at:], len(done)

    return replace


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = "n_values",
                 kinds: tuple[str, ...] = KINDS, back: bool = False) -> DataFrame:
    """All columns of ``docs``, in order, with ``text_col`` rewritten; then the
    number of replaced values (none if ``count_col`` is None).

    Defined cases: a null text stays null with 0 values, an empty one empty; a
    column named like the count is replaced; rows that repeat get the same
    text; an empty table gives no rows.  ``back`` reverses an earlier run.
    """
    if count_col:
        docs = without(docs, count_col)
    schema = T.StructType([*[field(docs, c) for c in docs.columns],
                           *([T.StructField(count_col, T.LongType())] if count_col else [])])
    at_text, secret = docs.columns.index(text_col), hashlib.sha256(key.encode()).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        replace, out = replacer(secret, kinds, back), to_arrow_schema(schema)
        with memory_given_back():
            for part in (p for batch in batches for p in parts_by_bytes(batch)):
                got = [(t, 0) if t is None else replace(t) for t in part.column(at_text).to_pylist()]
                columns = [c.cast(f.type) for c, f in zip(part.columns, out)]
                columns[at_text] = pa.array([g[0] for g in got], out.field(at_text).type)
                if count_col:
                    columns.append(pa.array([g[1] for g in got], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns]).mapInArrow(run, schema)
