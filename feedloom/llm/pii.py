"""Personal data: format-preserving Feistel pseudonyms.

Detected values are validated (check digit, calendar, address ranges) and
replaced by a keyed permutation within their own format: same length, same
separators, same alphabet, still valid.  The permutation depends only on the
key, the kind and the canonical value, so equal values stay equal across
documents and one that is written with other separators maps to the same
pseudonym.  With the key the mapping can be inverted.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import secrets as tokens
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, lean, plus, prepare

#: Session setting with the key.  Whoever has it can invert the pseudonyms, so
#: it has no default; see ``session_key``.
KEY_SETTING = "feedloom.pii.key"
ROUNDS = 10
DIGITS = "0123456789"
#: Characters of a secret that are permuted as one.
SECRET_BLOCK = 256
LOWER_HEX = "0123456789abcdef"
BASE36 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
BASE62 = DIGITS + BASE36[:26] + BASE36[:26].lower()
#: Calendar windows of the date permutation: each day stays in its own.
DAYS = [(a.toordinal(), b.toordinal()) for a, b in (
    (dt.date(1, 1, 1), dt.date(1899, 12, 31)), (dt.date(1900, 1, 1), dt.date(2099, 12, 31)), (dt.date(2100, 1, 1), dt.date(9999, 12, 31)))]


# ------------------------------------------------------------ permutation
def _round(key: bytes, i: int, n: int, value: int, mod: int) -> int:
    h = hashlib.blake2b(f"{i}/{n}/{value}".encode(), key=key, digest_size=24).digest()
    # as many bits as the half has, and 64 more
    need = (mod.bit_length() + 64 + 7) // 8
    if need > len(h):
        h = hashlib.shake_256(key + h).digest(need)
    return int.from_bytes(h, "big") % mod


def permute(key: bytes, value: int, a: int, b: int, inverse: bool = False) -> int:
    """Feistel permutation of 0..a*b-1: halves in Z_a and Z_b are added to in
    turn by a keyed hash of the other."""
    left, right = divmod(value, b)
    sign = -1 if inverse else 1
    for i in (range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)):
        if i % 2 == 0:
            left = (left + sign * _round(key, i, a * b, right, a)) % a
        else:
            right = (right + sign * _round(key, i, a * b, left, b)) % b
    return left * b + right


def walk(key: bytes, value: int, a: int, b: int, valid: Callable[[int], bool], inverse: bool = False) -> int:
    """Cycle walking: permute until the value is valid again.  Ends, as the
    start itself is valid and on the same cycle."""
    while True:
        value = permute(key, value, a, b, inverse)
        if valid(value):
            return value


def permute_string(key: bytes, text: str, alphabet: str, inverse: bool = False) -> str:
    """Permutation of the strings of this length over ``alphabet``."""
    r, n = len(alphabet), len(text)
    if not n:
        return text
    value = 0
    for c in text:
        value = value * r + alphabet.index(c)
    a, b = r ** (n - n // 2), r ** (n // 2)
    if n == 1:
        a, b = r, 1
    value = permute(key, value, a, b, inverse)
    out = []
    for _ in range(n):
        value, d = divmod(value, r)
        out.append(alphabet[d])
    return "".join(reversed(out))


# ------------------------------------------------------------ validators
def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _fill(pattern: str, chars: str) -> str:
    """``pattern`` with its digits replaced in turn."""
    it = iter(chars)
    return "".join(next(it) if c.isdigit() else c for c in pattern)


class Pseudonymiser:
    """Replaces every validated value of a text; see ``replace``."""

    def __init__(self, key: str, inverse: bool = False):
        if not key:
            raise ValueError(f"pseudonyms need a key; set {KEY_SETTING}")
        self.inverse = inverse
        self._key = {k: hashlib.blake2b(f"{key}/{k}".encode(), digest_size=32).digest()
                     for k in ("card", "number", "phone", "ssn", "date", "ip", "mail", "iban", "secret")}
        self.card = lru_cache(1 << 15)(self._card)
        self.phone = lru_cache(1 << 15)(self._phone)
        self.mail = lru_cache(1 << 15)(self._mail)
        self.ip = lru_cache(1 << 15)(self._ip)
        self.day = lru_cache(1 << 15)(self._day)

    # each takes the matched text and returns its pseudonym, or None if the
    # text isn't a valid value of the kind
    def _card(self, s: str) -> str | None:
        """13 to 19 digits: issuer digit kept, check digit made anew.  16 digits
        that start like a card but have a wrong check digit (a typing slip)
        are permuted and keep a wrong one; other numbers without a valid one
        (times, ISBNs) are no cards."""
        d = re.sub(r"\D", "", s)
        if not 13 <= len(d) <= 19 or len(set(d)) == 1:
            return None
        head, body = d[0], d[1:-1]
        if luhn_digit(d[:-1]) == d[-1]:
            new = head + permute_string(self._key["card"], body, DIGITS, self.inverse)
            return _fill(s, new + luhn_digit(new))
        if len(d) != 16 or head not in "3456":
            return None
        new = head + permute_string(self._key["number"], body, DIGITS, self.inverse)
        # the offset from the right check digit (1..9) stays, so it stays invalid
        off = (int(d[-1]) - int(luhn_digit(d[:-1]))) % 10
        return _fill(s, new + str((int(luhn_digit(new)) + off) % 10))

    def _phone(self, s: str) -> str | None:
        """North American numbers: area code and exchange start with 2-9."""
        d = re.sub(r"\D", "", s)
        lead, d = ("1", d[1:]) if len(d) == 11 and d[0] == "1" else ("", d)
        if len(d) != 10:
            return None
        ok = lambda v: v // 10**9 >= 2 and v // 10**6 % 10 >= 2
        if ok(int(d)):
            new = walk(self._key["phone"], int(d), 10**5, 10**5, ok, self.inverse)
        else:
            new = walk(self._key["phone"], int(d), 10**5, 10**5, lambda v: not ok(v), self.inverse)
        return _fill(s, lead + f"{new:010d}")

    def intl(self, s: str) -> str | None:
        """Other international numbers: country digits kept, the rest permuted."""
        d = re.sub(r"\D", "", s)
        if not 8 <= len(d) <= 15:
            return None
        if len(d) == 11 and d[0] == "1":
            # one number, with or without signs between
            return self.phone(s)
        return _fill(s, d[:2] + permute_string(self._key["phone"], d[2:], DIGITS, self.inverse))

    def ssn(self, s: str) -> str | None:
        d = s.replace("-", "")
        ok = lambda v: 0 < v // 10**6 < 900 and v // 10**6 != 666 and v // 10**4 % 100 and v % 10**4 > 0
        if not ok(int(d)):
            return None
        return _fill(s, f"{walk(self._key['ssn'], int(d), 10**5, 10**4, ok, self.inverse):09d}")

    def _ip(self, s: str) -> str | None:
        octets = [int(x) for x in s.split(".")]
        if any(o > 255 for o in octets) or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
            return None
        value = int.from_bytes(bytes(octets), "big")
        return ".".join(map(str, permute(self._key["ip"], value, 1 << 16, 1 << 16, self.inverse).to_bytes(4, "big")))

    def _mail(self, s: str) -> str | None:
        """Letters and digits of the local part, case by case; domain kept."""
        local, _, domain = s.rpartition("@")
        if not local or ".." in local or ".." in domain:
            return None
        chars = [c for c in local if c.isalnum()]
        low = "abcdefghijklmnopqrstuvwxyz"
        # letters and digits are permuted apart, so each keeps its place's class
        letters = "".join(c.lower() for c in chars if c.isalpha())
        digits = "".join(c for c in chars if c.isdigit())
        key = hashlib.blake2b(domain.lower().encode(), key=self._key["mail"], digest_size=32).digest()
        a, b = iter(permute_string(key, letters, low, self.inverse)), iter(permute_string(key, digits, DIGITS, self.inverse))
        out = []
        for c in local:
            if c.isalpha():
                x = next(a)
                out.append(x.upper() if c.isupper() else x)
            else:
                out.append(next(b) if c.isdigit() else c)
        return "".join(out) + "@" + domain

    def iban(self, s: str) -> str | None:
        """Account digits permuted, the two check digits made anew."""
        c = s.replace(" ", "").upper()
        number = lambda x: int("".join(str(int(ch, 36)) for ch in x[4:] + x[:4]))
        if not 15 <= len(c) <= 34 or number(c) % 97 != 1:
            return None
        body = _fill(c[4:], permute_string(self._key["iban"], re.sub(r"\D", "", c[4:]), DIGITS, self.inverse))
        new = c[:2] + f"{98 - number(c[:2] + '00' + body) % 97:02d}" + body
        it = iter(new)
        return "".join(" " if ch == " " else next(it).lower() if ch.islower() else next(it) for ch in s)

    def secret(self, s: str, alphabets: tuple[str, ...] = (LOWER_HEX, BASE36, BASE62 + "+/=_-.")) -> str:
        """Keys and tokens over the first of the alphabets that holds them."""
        for alphabet in alphabets:
            if all(c in alphabet for c in s):
                break
        else:
            return s
        # long ones by blocks, each under a key that the block before it gives
        key, out = self._key["secret"], []
        for lo in range(0, len(s), SECRET_BLOCK):
            block = s[lo:lo + SECRET_BLOCK]
            out.append(permute_string(key, block, alphabet, self.inverse))
            plain = out[-1] if self.inverse else block
            key = hashlib.blake2b(f"{lo}/{plain}".encode(), key=self._key["secret"], digest_size=32).digest()
        return "".join(out)

    def _day(self, ordinal: int) -> int:
        """Days of the month above 12 and others are permuted apart, so that
        each way of writing one is read again in the same order."""
        first, last = next(x for x in DAYS if x[0] <= ordinal <= x[1])
        n = last - first + 1
        b = int(n**0.5) + 1
        a = -(-n // b)
        late = lambda v: dt.date.fromordinal(first + v).day > 12
        high = late(ordinal - first)
        return first + walk(self._key["date"], ordinal - first, a, b, lambda v: v < n and late(v) == high, self.inverse)

    def date(self, m: re.Match) -> str | None:
        """Real calendar days; the written order, separators and padding stay.
        Month first with slashes, day first with others, or else the other way
        round if that is no calendar day."""
        g = m.groupdict()
        if g["iso"]:
            sep, orders = g["s1"], {"ymd": (g["y"], g["m"], g["d"])}
        else:
            sep, mdy, dmy = g["s2"], (g["y2"], g["p"], g["q"]), (g["y2"], g["q"], g["p"])
            orders = {"mdy": mdy, "dmy": dmy} if sep == "/" else {"dmy": dmy, "mdy": mdy}
        for order, (y, mo, d) in orders.items():
            try:
                old = dt.date(int(y), int(mo), int(d)).toordinal()
                break
            except ValueError:
                continue
        else:
            return None
        new = dt.date.fromordinal(self.day(old))
        two = order == "ymd" or (len(d) == 2 and len(mo) == 2)
        f = (lambda v: f"{v:02d}") if two else str
        parts = {"y": f"{new.year:04d}", "m": f(new.month), "d": f(new.day)}
        return sep.join(parts[c] for c in order)


# ------------------------------------------------------------ detection
#: Tried in this order at each place; the first valid match wins.  A value
#: ends at anything but an ASCII letter, "_" or a digit of any script, so
#: text without blanks between words may touch it.
_PATTERN = re.compile(r"""
    (?P<mail>(?<![A-Za-z_\d.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z_\d-]))
  | (?P<aws>(?<![A-Za-z0-9])(?:AKIA|ASIA)(?P<awsid>[A-Z0-9]{16})(?![A-Za-z0-9]))
  | (?P<cred>(?i:(?<![A-Za-z_\d])(?:password|passwd|pwd|token|secret|api[_-]?key))\s{0,3}[=:]\s{0,3}["']?(?P<val>[A-Za-z0-9+/=_.-]{8,}))
  | (?P<bare>(?<![A-Za-z0-9_-])(?:gh[pousr]_|github_pat_|glpat-|sk-|[sprk]k_(?:live|test)_|xox[abprs]-)(?P<bareid>[A-Za-z0-9_-]{16,}))
  | (?P<iban>(?<![A-Za-z0-9])(?i:[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?![A-Za-z0-9]))
  | (?P<date>(?<![A-Za-z_\d.,/-])(?:(?P<iso>(?P<y>[0-9]{4})(?P<s1>[-/.])(?P<m>[0-9]{1,2})(?P=s1)(?P<d>[0-9]{1,2}))
       |(?P<p>[0-9]{1,2})(?P<s2>[-/.])(?P<q>[0-9]{1,2})(?P=s2)(?P<y2>[0-9]{4}))
       (?:(?![A-Za-z_\d/-]|[.][0-9])|(?=[Tt][0-9]|[Zz](?![A-Za-z_\d])|[_-][0-9]{1,2}:[0-9]{2})))
  | (?P<ip>(?<![A-Za-z_\d.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![A-Za-z_\d]|\.[0-9]))
  | (?P<ssn>(?<![A-Za-z_\d-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z_\d-]))
  | (?P<card>(?<![A-Za-z_\d.+-])(?:[0-9]{13,19}|[0-9]{4}(?P<c1>[ -])[0-9]{4}(?P=c1)[0-9]{4}(?P=c1)[0-9]{1,7}
       |[0-9]{4}(?P<c2>[ -])[0-9]{6}(?P=c2)[0-9]{4,5})(?![A-Za-z_\d]|[-.][0-9]))
  | (?P<phone>(?<![A-Za-z_\d.])(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![A-Za-z_\d]|[-.][0-9]))
  | (?P<intl>(?<![A-Za-z_\d])\+[0-9](?:[ .()-]{0,2}[0-9]){7,14}(?![A-Za-z_\d]))
""", re.X)
_MAY = re.compile(r"[0-9@=:]|A[KS]IA|(?:gh[pousr]|pat|live|test)_|(?:sk|xox[abprs])-")
KINDS = ("mail", "aws", "cred", "bare", "iban", "date", "ip", "ssn", "card", "phone", "intl")


def pseudonymise(text: str, p: Pseudonymiser) -> tuple[str, int]:
    """The text with every valid value replaced, and how many there were."""
    if not _MAY.search(text):
        return text, 0
    count = 0

    def one(m: re.Match) -> str:
        nonlocal count
        s = m.group()
        kind = next(k for k in KINDS if m.group(k) is not None)
        if kind == "date":
            new = p.date(m)
        elif kind == "aws":
            new = s[:4] + permute_string(p._key["secret"], m.group("awsid"), BASE36, p.inverse)
        elif kind in ("cred", "bare"):
            own = "val" if kind == "cred" else "bareid"
            value = m.group(own)
            new = s[:m.start(own) - m.start()] + (p.secret(value) if kind == "cred" else p.secret(value, (BASE62, BASE62 + "_-")))
        else:
            new = getattr(p, kind)(s)
        if new is None:
            return s
        count += 1
        return new

    return _PATTERN.sub(one, text), count


_RUN_KEYS: dict[str, str] = {}


def session_key(spark: SparkSession) -> str:
    """The key that ``KEY_SETTING`` names; where it is unset, one drawn for
    this application alone and kept nowhere: values are linked within the run,
    and nobody can invert them afterwards."""
    app = spark.sparkContext.applicationId
    return spark.conf.get(KEY_SETTING, None) or _RUN_KEYS.setdefault(app, tokens.token_hex(32))


def pseudonymise_documents(docs: DataFrame, key: str, text_col: str = "text",
                           count_col: str | None = "n_pii", inverse: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; all other columns
    pass through.  ``count_col`` (None: left out) gets the number of values
    replaced; an existing column of that name is replaced.

    One pass without a shuffle; a missing key is an error.  Texts and secrets
    of any length are taken whole; ties don't arise.  Null texts stay null with count 0; empty
    texts stay empty; repeated rows give repeated results; an empty table
    gives no rows; a value that fails validation is left as it stands."""
    cols = [c for c in docs.columns if c != count_col]
    src = docs.select(*[docs[f"`{c}`"] for c in cols])
    schema = plus(src, count_col, "long") if count_col else src.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pseudonymiser(key, inverse)
        at = cols.index(text_col)
        for b in batches:
            texts, counts = [], []
            for t in b.column(at):
                t = t.as_py()
                new, n = (None, 0) if t is None else pseudonymise(t, p)
                texts.append(new)
                counts.append(n)
            arrays = list(b.columns)
            arrays[at] = pa.array(texts, pa.string())
            if count_col:
                arrays.append(pa.array(counts, pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*cols, *([count_col] if count_col else [])])

    return src.mapInArrow(lean(run), schema)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text with pseudonyms, n_pii of every document, under the
    session's key.  Nulls, empty and long texts, repeats, empty tables: as
    stated by ``pseudonymise_documents``."""
    prepare(spark)
    return pseudonymise_documents(documents(spark, sf_dir).select("doc_id", "text"), session_key(spark))
