"""Format-preserving pseudonyms for validated numbers, dates and addresses in texts.

A value is replaced only if it is valid in its format (Luhn digit, check digits, calendar day, area code, octets). Every format is
a numbered set: a value has a rank below the size of its set, a keyed Feistel network permutes the ranks, and the
new rank is written in the same format, with check digits made anew. Networks run over the next even number of bits, and ranks beyond
the set are permuted again (cycle walking), so the whole is a permutation of the set: equal values get equal pseudonyms
in all documents, different ones different ones, and who has the key can undo it. Lengths, separators and positions
stay. A card or IBAN ends at the first separator where it is valid, whatever number or word follows. Undoing reads the new text afresh: a number
that stands right before a card can by chance make a valid card together with the new digits, and is then undone wrongly.

Defined cases: a null text stays null; texts without such values stay as they are, byte for byte; repeated rows get equal texts;
other columns pass through; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

ROUNDS = 8
FIRST_DAY, DAYS = date(1900, 1, 1), 73_049  # to 2099-12-31


@lru_cache(maxsize=1 << 16)
def permute(rank: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0 .. size - 1."""
    if size < 2:
        return rank
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    order = range(ROUNDS)
    while True:
        a, b = rank >> half, rank & mask
        for i in reversed(order) if back else order:
            said = hashlib.blake2b(f"{tweak}/{size}/{i}/{a if back else b}".encode(), key=key, digest_size=32).digest()
            f = int.from_bytes(said, "big") & mask
            a, b = (b ^ f, a) if back else (b, a ^ f)
        rank = a << half | b
        if rank < size:
            return rank


def luhn(digits: str) -> int:
    """The digit that makes ``digits`` valid when it is appended."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(digits)))
    return -total % 10


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _refill(shape: str, chars: str) -> str:
    """``shape`` with its letters and digits replaced in order."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _card(m: re.Match, p: Callable) -> str | None:
    d = _digits(m[0])
    if not 13 <= len(d) <= 19 or luhn(d[:-1]) != int(d[-1]) or len(set(d)) == 1:
        return None
    n = len(d) - 2
    short = lambda x: len(x) > 16 and luhn(x[:15]) == int(x[15])
    new = d
    while True:  # what begins with a valid card goes to such a one, so the new text is read with the same ends
        new = new[0] + str(p(int(new[1:-1]), 10**n, f"card{d[0]}{n}")).zfill(n)
        new += str(luhn(new))
        if short(new) == short(d) and len(set(new)) > 1:
            return _refill(m[0], new)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


#: Length of an IBAN by country; other countries' are valid from 15 to 34.
_IBAN_SIZE = {c: int(n) for n, names in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL "
    "24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU 31:MT,SC 32:LC 33:RU"
).split()) for c in names.split(",")}


def _iban(m: re.Match, p: Callable) -> str | None:
    s = re.sub(r"\s", "", m[0])
    if not 15 <= len(s) <= 34 or _IBAN_SIZE.get(s[:2], len(s)) != len(s) or _mod97(s[4:] + s[:4]) != 1:
        return None
    spots = [i for i in range(4, len(s)) if s[i].isdigit()]
    new = list(s)
    digits = str(p(int("".join(s[i] for i in spots) or 0), 10 ** len(spots), f"iban{s[:2]}{len(s)}")).zfill(len(spots))
    for i, c in zip(spots, digits, strict=False):
        new[i] = c
    new[2:4] = f"{98 - _mod97(''.join(new[4:]) + s[:2] + '00'):02d}"
    return _refill(m[0], "".join(new))


def _phone(m: re.Match, p: Callable) -> str | None:
    """Ten digits, and the 1 before them: areas and exchanges from 200 stay from 200, others stay below."""
    d = _digits(m[0])
    head, d = (d[0], d[1:]) if len(d) == 11 else ("", d)
    if len(d) != 10 or head not in ("", "1"):
        return None
    (low, n), (low2, n2) = ((200, 800) if int(x) >= 200 else (0, 200) for x in (d[:3], d[3:6]))
    rank = p(((int(d[:3]) - low) * n2 + int(d[3:6]) - low2) * 10_000 + int(d[6:]), n * n2 * 10_000, f"phone{low}{low2}")
    rest, line = divmod(rank, 10_000)
    return _refill(m[0], f"{head}{rest // n2 + low:03d}{rest % n2 + low2:03d}{line:04d}")


def _social(m: re.Match, p: Callable) -> str | None:
    a, g, s = int(m[0][:3]), int(m[0][4:6]), int(m[0][7:])
    areas = [x for x in range(1, 900) if x != 666]
    if a not in areas or not g or not s:
        return None
    rank = p((areas.index(a) * 99 + g - 1) * 9999 + s - 1, len(areas) * 99 * 9999, "social")
    rest, s = divmod(rank, 9999)
    return f"{areas[rest // 99]:03d}-{rest % 99 + 1:02d}-{s + 1:04d}"


#: Octets by number of digits: lowest, how many.
_OCTETS = {1: (0, 10), 2: (10, 90), 3: (100, 156)}


def _address(m: re.Match, p: Callable) -> str | None:
    parts = m[0].split(".")
    rank, size, spans = 0, 1, []
    for part in parts:
        low, n = _OCTETS[len(part)]
        at = int(part) - low
        if not 0 <= at < n or str(int(part)) != part:
            return None
        rank, size = rank * n + at, size * n
        spans.append((low, n))
    rank, out = p(rank, size, "address" + "".join(map(str, map(len, parts)))), []
    for low, n in reversed(spans):
        rank, at = divmod(rank, n)
        out.append(str(low + at))
    return ".".join(reversed(out))


def _date(m: re.Match, p: Callable) -> str | None:
    a, b, c = (int(x) for x in re.split(r"[-/.]", m[0]))
    year_first = len(m[0].split(m["s"])[0]) == 4
    for y, mo, d, order in ((a, b, c, "ymd"),) if year_first else ((c, b, a, "dmy"), (c, a, b, "mdy")):
        try:
            n = (date(y, mo, d) - FIRST_DAY).days
        except ValueError:
            continue
        if 0 <= n < DAYS:
            new = FIRST_DAY + timedelta(days=p(n, DAYS, "day"))
            text = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
            if order == "mdy" and new.day <= 12:  # else it would be read the other way round
                order = "dmy"
            return m["s"].join(text[x] for x in order)
    return None


def _mail(m: re.Match, p: Callable) -> str | None:
    local, at, host = m[0].partition("@")
    rank, size, kinds = 0, 1, []
    for c in local:
        first, n = next(((ord(f), n) for f, n in (("a", 26), ("A", 26), ("0", 10)) if 0 <= ord(c) - ord(f) < n), (0, 0))
        kinds.append((first, n, c))
        if n:
            rank, size = rank * n + ord(c) - first, size * n
    shape = "".join({97: "a", 65: "A", 48: "0"}.get(f, c) for f, n, c in kinds)
    rank, out = p(rank, size, f"mail/{shape}"), []
    for first, n, c in reversed(kinds):
        if n:
            rank, i = divmod(rank, n)
            c = chr(first + i)
        out.append(c)
    return "".join(reversed(out)) + at + host


#: Kind -> (pattern, writer); an earlier kind goes first where two overlap.
KINDS: dict[str, tuple[str, Callable]] = {
    "mail": (r"(?<![\w.+-])[A-Za-z0-9](?:[\w.+-]{0,62}[A-Za-z0-9])?@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", _mail),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    "date": (r"(?<![\d./-])(?:\d{4}(?P<s1>[-/.])\d{2}(?P=s1)\d{2}|\d{2}(?P<s2>[-/.])\d{2}(?P=s2)\d{4})(?![\d/-])", _date),
    "address": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", _address),
    "phone": (r"(?<![\w+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)|(?<![\w+])\+1\d{10}(?!\w)", _phone),
    "social": (r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _social),
    "card": (r"(?<![\w.])\d(?:[ -]?\d){12,18}(?![\w])", _card),
}
_ONE = {k: re.compile(p) for k, (p, _) in KINDS.items()}
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, (p, _) in KINDS.items()))


class _View:
    """A match of one kind, by the names that the writers use."""

    def __init__(self, text: str, sep: str | None = None):
        self.text, self.sep = text, sep

    def __getitem__(self, name):
        return self.text if name == 0 else self.sep


def _readings(text: str, at: int) -> Iterator[tuple[str, str, str | None]]:
    """(kind, value, separator) of every reading of the text from ``at``: kinds in order; cards and IBANs may end at each separator, the shortest first."""
    for kind, pattern in _ONE.items():
        m = pattern.match(text, at)
        if not m:
            continue
        whole = m[0]
        if kind in ("card", "iban"):
            for i in range(1, len(whole)):
                if whole[i] in " -":
                    yield kind, whole[:i], None
        yield kind, whole, (m["s1"] or m["s2"]) if kind == "date" else None


def pseudonymize_text(text: str, key: bytes, back: bool = False) -> tuple[str, int]:
    """(new text, number of values replaced)."""
    found, at, out = 0, 0, []
    p = lambda rank, size, tweak: permute(rank, size, key, tweak, back)
    done = 0
    while m := _ANY.search(text, at):
        # what no kind takes is passed by to its next separator only, so a value inside it is still found
        at = m.end() if m.lastgroup == "mail" else m.start() + max(1, len(re.match(r"[^ -]*", m[0])[0]))
        for kind, value, sep in _readings(text, m.start()):
            new = KINDS[kind][1](_View(value, sep), p)
            if new is not None:
                out += text[done : m.start()], new
                done = at = m.start() + len(value)
                found += 1
                break
    return "".join(out) + text[done:], found


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text", count: str = "n_replaced") -> DataFrame:
    """``docs`` with pseudonyms in its texts and the number of values replaced."""
    docs = docs.drop(count)
    at = docs.columns.index(text)
    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            some = pc.fill_null(pc.match_substring_regex(column, "[0-9@]"), False)
            new, n = [], []
            for value, may in zip(column, some.to_pylist(), strict=True):
                value, k = pseudonymize_text(value.as_py(), key) if may else (value.as_py(), 0)
                new.append(value)
                n.append(k)
            columns = list(batch.columns)
            columns[at] = pa.array(new, column.type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], [*batch.schema.names, count])

    return docs.mapInArrow(run, f"{plain}, `{count}` long")
