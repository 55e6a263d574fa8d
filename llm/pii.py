"""Personal data replaced by surrogates that keep type, gender, script and format.

Detected: e-mail addresses, IPv4 and IPv6 addresses, telephone numbers, card numbers of 13 to 19 digits, account numbers (IBAN
with a right check sum), social security numbers, dates of birth, access keys and bearer tokens, values of passwords, tokens
and the like, and names after a title; in the text of such a name its bare family name and its full name count too, wherever
they stand.  Not detected: names that no title introduces, postal addresses, telephone numbers in other national forms.

An entity is known by its canonical form, so one number has one surrogate however it is written, in all documents
(coreference), and its surrogate is written as the number was.  A surrogate comes from a keyed, format-preserving permutation:
letters stay letters of their case and script, digits digits, hexadecimal strings hexadecimal, signs stay, save in a secret of
so few letters and digits that under a million could be told apart, which gets random letters; an address keeps its top-level
domain and one domain always gets one surrogate; a card keeps whether its check digit is right, an IBAN its country and a right
check sum; a telephone number keeps its country; a date stays one.  Given and family names of Latin and Cyrillic script are
composed of syllables, so many that few of the corpus's names collide, a given name with an ending for its title's gender;
names of other scripts are permuted within their own.  So different entities of one format differ by construction.

Collision checks cover what the permutation can't: a surrogate that two entities share, or that occurs as an entity of the
corpus, or that equals its entity.  All but the first of such entities move on to their next surrogate until none is left.
Where a format has no free surrogate, so that some still collide after ``most`` rounds, those get random letters, more of them
in each further round: they give up the format (an address only its local part, a name the number of syllables).
Only these exceptions are shipped to the replacing pass: by broadcast up to ``broadcast_rows``, by a join beyond.

Defined results for odd input: a null text stays null, an empty one empty, both without entities.  Texts are read whole.
Rows are judged on their own, repeated rows give repeated results.  An empty table gives an empty result.  Other columns pass
through, whatever their names, save ``n_entities`` and ``kinds``, which are replaced.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import ipaddress
import itertools
import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import hot_keys, materialize, remove, sliced, spare, spread_join, table

# Titles by gender, roles that follow a title without being a name, particles of family names.
TITLES = {
    "f": "Mrs Ms Miss Frau Señora Señorita Sra Madame Mme Mademoiselle госпожа".split(),
    "m": "Mr Mister Herr Señor Sr Monsieur господин".split(),
    "n": "Dr Prof Professor Professorin Doctor Docteur Doktor доктор профессор".split(),
}
ROLES = frozenset(
    "President Chairman Chairwoman Chair Speaker Minister Secretary Justice Chancellor Mayor Governor Senator Ambassador "
    "Präsident Präsidentin Kanzler Kanzlerin Ministerin Président Présidente Ministre Presidente Ministro Ministra".split()
)
PARTICLES = "von|van|der|den|de|del|la|di|da"
SYLLABLES = {
    "LATIN": "ba be bo da de do fa ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va vo".split(),
    "CYRILLIC": "ба бо ва во га да до ка ко ла ло ма мо на но ра ро са со та".split(),
}
ENDINGS = {"LATIN": {"f": "nia", "m": "nto", "n": "ris"}, "CYRILLIC": {"f": "ния", "m": "нт", "n": "рис"}}
# Countries whose calling codes have one or two digits; all others have three.
CALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_TITLE = r"(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\b\.?"
_WORD = r"(?:(?:" + PARTICLES + r")[ ])*[^\W\d_a-z][\w'’-]+"
PATTERNS = (
    ("secret", r"(?i:\b(?:password|passwd|pwd|passphrase)\b\s*[=:]\s*[\"']?)(?P<secret>[^\s\"'<>]{6,})"),
    ("token", r"(?i:\b(?:token|secret|api[_-]?key|access[_-]?key)\b\s*[=:]\s*[\"']?)(?P<token>(?=[^\s\"'<>]*[\d_*•+/=-])[^\s\"'<>]{6,})"),
    ("bearer", r"(?i:\bbearer\s+)(?P<bearer>(?=[\w.~+/-]*\d)[\w.~+/-]{16,}=*)"),
    ("email", r"(?<![\w.+-])(?P<email>[^\W_](?:[\w.+-]*[\w+-])?@[A-Za-z0-9](?:[A-Za-z0-9-]*)(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"),
    ("ip", r"(?<![\w.])(?P<ip>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?!\w|\.\d)"),
    ("ip6", r"(?<![\w:.])(?P<ip6>(?=[0-9A-Fa-f:]*\d)(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4})(?![\w:]|\.\d)"),
    ("ssn", r"(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"),
    ("iban", r"\b(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b"),
    ("phone", r"(?<![\w+])(?P<phone>\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}|0\d{1,4}[ /-]\d{3,9}(?:[ -]\d{2,5}){0,3})(?![\w-])"),
    ("card", r"(?<![\w-])(?P<card>\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])"),
    ("key", r"\b(?P<key>A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|xox[abp]-[A-Za-z0-9-]{16,})\b"),
    ("birth", r"(?i:\b(?:born(?: on)?|birth ?da(?:y|te)|date of birth|dob|geboren(?: am)?|geb\.|née? le|nacid[oa] el|fecha de nacimiento)[: ]{1,3})(?P<birth>\d{4}-\d{2}-\d{2}|\d{1,2}[./-]\d{1,2}[./-]\d{4})(?!\d)"),
    ("name", r"\b(?P<title>" + _TITLE + r"(?:[ ]" + _TITLE + r")*)[ ](?P<name>" + _WORD + r"(?:[ ]" + _WORD + r"){0,2})"),
)
FIND = re.compile("|".join(p for _, p in PATTERNS))
#: A text without any of these has no entity.
HINT = re.compile(r"[0-9@=:]|(?i:\bbearer\b)|\b" + _TITLE)
#: What makes four numbers a version or a section rather than an address.
NUMBERED = re.compile(r"(?i:\b(?:version|ver|release|build|section|chapter|v)\.?|§)\s*\Z")
KINDS = tuple(k for k, _ in PATTERNS)
GENDER = {t: g for g, ts in TITLES.items() for t in ts}
#: Attempts from here on don't keep the format.
FREE = 1000
#: A secret that has fewer forms than this under the permutation gets random letters.
FORMS = 10**6
#: Names are so long that there are this many forms for each name of the corpus.
ROOM = 256
SECRETS = ("secret", "token", "bearer")
ASCII = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Dates of birth lie in so many days from the first of 1900.
DAYS, FIRST_DAY = 200 * 229, datetime.date(1900, 1, 1).toordinal()


@lru_cache(maxsize=20_000)
def alphabet(c: str) -> str:
    """The characters that may stand for ``c``: ASCII of its class, else the letters or digits of its script, case and
    Unicode neighbourhood; empty for a sign."""
    for k in ASCII:
        if c in k:
            return k
    kind, script = unicodedata.category(c), unicodedata.name(c, "").split(" ")[0]
    if kind[0] != "L" and kind != "Nd":
        return ""
    return "".join(x for x in map(chr, range(ord(c) & ~0x7F, (ord(c) | 0x7F) + 1)) if unicodedata.category(x) == kind and unicodedata.name(x, "").split(" ")[0] == script)


def luhn(digits: list[int]) -> int:
    """The check digit that follows ``digits``."""
    return -sum(d if i % 2 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10


def iban_check(country: str, rest: str) -> int:
    """The check number of an account number, of 2 to 98."""
    return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


def _date(value: str) -> tuple[datetime.date, str] | None:
    """The day and its order of year, month and day; None if there is no such day since 1900 or it lies ahead."""
    a, b, c = map(int, re.split(r"[./-]", value))
    order = "ymd" if len(value.split("-")[0]) == 4 else "mdy" if b > 12 else "dmy"
    part = dict(zip(order, (a, b, c)))
    try:
        day = datetime.date(part["y"], part["m"], part["d"])
    except ValueError:
        return None
    return (day, order) if 0 <= day.toordinal() - FIRST_DAY < DAYS else None


def _is(kind: str, value: str, text: str, at: int) -> bool:
    """What the patterns can't say of a match that begins at ``at``."""
    if kind == "ip":
        return not NUMBERED.search(text[max(0, at - 12) : at])
    if kind == "ip6":
        try:
            ipaddress.IPv6Address(value)
        except ValueError:
            return False
        return sum(map(bool, value.split(":"))) > 1
    if kind == "iban":
        plain = value.replace(" ", "")
        return 15 <= len(plain) <= 34 and iban_check(plain[:2], plain[4:]) == int(plain[2:4])
    if kind == "phone":
        return 8 <= sum(map(str.isdigit, value)) <= 15
    if kind == "birth":
        return _date(value) is not None
    if kind == "name":
        return value.split(" ")[0] not in ROLES
    return True


def _words(name: str) -> list[str]:
    """The given names and the family name of a match: without particles, up to the first word in lower case."""
    out = []
    for w in name.split(" "):
        if w in PARTICLES.split("|"):
            continue
        if w[0].islower():
            break
        out.append(re.sub(r"['’]s?\Z", "", w))
    return out


def _named(text: str, names: list[tuple[str, list[str]]], taken: list[tuple[str, str, int, int]]) -> list[tuple[str, str, int, int]]:
    """Given and family names of the titled ``names`` (gender, given names and family name), and of their other mentions outside ``taken``."""
    people: dict[str, tuple[str, set[str]]] = {}
    for gender, (*given, last) in names:
        known, givens = people.get(last, ("n", set()))
        people[last] = (gender if known == "n" else known, givens | set(given))
    for last, (gender, givens) in [*people.items()]:
        people.setdefault(last.upper(), (gender, givens | {g.upper() for g in givens}))
    out, busy = [], bytearray(len(text) + 1) if taken else b""
    for _, _, lo, hi in taken:
        busy[lo:hi] = b"\1" * (hi - lo)
    family = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, people), key=lambda x: (-len(x), x))) + r")(?!\w)")
    for m in family.finditer(text):
        if busy and any(busy[m.start() : m.end()]):
            continue
        gender, givens = people[m[0]]
        found, at = [("family", m[0], *m.span())], m.start()
        while before := re.search(r"(?<!\w)(?:((?:" + PARTICLES + r") )|(\w[\w'’-]*) )\Z", text[max(0, at - 60) : at]):
            lo = at - len(before[0])
            if before[2] and before[2] in givens:
                found.append((f"given:{gender}", before[2], lo, at - 1))
            elif before[2]:
                break
            at = lo
        out += found
    return out


def entities(text: str) -> list[tuple[str, str, int, int]]:
    """Kind, value and span of each entity, in order; a name's parts are of kind ``family`` and, by gender, ``given:f`` and so on."""
    if not HINT.search(text):
        return []
    out, names = [], []
    for m in FIND.finditer(text):
        kind = next(k for k in KINDS if m[k] is not None)
        if not _is(kind, m[kind], text, m.start(kind)):
            continue
        if kind == "name":
            gender = next((g for t in re.findall(r"\w+", m["title"]) if (g := GENDER[t]) != "n"), "n")
            if parts := _words(m[kind]):
                names.append((gender, parts))
        else:
            out.append((kind, m[kind], *m.span(kind)))
    if not names:
        return out
    parts, end = [], 0
    for e in sorted([*out, *_named(text, names, out)], key=lambda e: e[2]):
        if e[2] >= end:  # a given name can be another's family name
            parts.append(e)
            end = e[3]
    return parts


def canonical(kind: str, value: str) -> str:
    """What an entity is known by, however it is written."""
    if kind == "phone":
        digits = "".join(c for c in value if c.isdigit())
        if value.startswith("+"):
            return "+" + digits
        return digits if digits.startswith("0") else "+1" + digits
    if kind in ("card", "ssn"):
        return "".join(c for c in value if c.isdigit())
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "birth":
        return _date(value)[0].isoformat()
    if kind in ("email", "ip6", "family") or kind.startswith("given:"):
        return value.lower()
    return value


def _filled(value: str, fill: str, of) -> str:
    """``value`` with its characters of which ``of`` is true replaced by the last characters of ``fill``, in order."""
    many = sum(map(of, value))
    at = iter(fill[len(fill) - many :] if many else "")
    return "".join(next(at) if of(c) else c for c in value)


def written(kind: str, value: str, new: str) -> str:
    """The surrogate ``new`` of the canonical form, written as ``value`` is."""
    if kind in ("phone", "card", "ssn"):
        digits = [c for c in new if c.isdigit()]
        return _filled(value, "".join(digits), str.isdigit) if len(digits) >= sum(map(str.isdigit, value)) else new
    if kind == "iban" and len(new) == len(value.replace(" ", "")):
        return _filled(value, new, lambda c: c != " ")
    if kind == "birth" and re.fullmatch(r"\d{4}-\d{2}-\d{2}", new):
        day, order = datetime.date.fromisoformat(new), _date(value)[1]
        wide = [len(x) for x in re.split(r"[./-]", value)]
        part = {"y": day.year, "m": day.month, "d": day.day}
        sign = re.search(r"[./-]", value)[0]
        return sign.join(f"{part[k]:0{2 if n == 2 else 4 if k == 'y' else 1}d}" for k, n in zip(order, wide))
    if kind == "family" or kind.startswith("given:"):
        return new.upper() if value.isupper() and len(value) > 1 else new[:1].upper() + new[1:]
    if kind in ("email", "ip6") and len(new) == len(value):
        return "".join(n.upper() if c.isupper() and len(n.upper()) == 1 else n for c, n in zip(value, new))
    return new


class Surrogates:
    """Surrogates of canonical forms by key; ``attempt`` numbers the permutations of an entity that had to move on."""

    def __init__(self, key: str, syllables: int = 3):
        self.key, self.syllables = key.encode(), syllables
        self.of = lru_cache(maxsize=20_000)(self._of)

    def _draw(self, *what: object) -> int:
        return int.from_bytes(hmac.new(self.key, "\x1f".join(map(str, what)).encode(), hashlib.sha256).digest(), "big")

    def permute(self, digits: list[int], radix: list[int], tweak: str) -> list[int]:
        """A keyed permutation of digit strings with the given radices: a Feistel network on the two halves."""
        h = len(digits) // 2
        value, size = [0, 0], [1, 1]
        for side, part in enumerate((range(h), range(h, len(digits)))):
            for i in part:
                value[side], size[side] = value[side] * radix[i] + digits[i], size[side] * radix[i]
        for r in range(8):
            value[r % 2] = (value[r % 2] + self._draw(tweak, r, size, value[1 - r % 2])) % size[r % 2]
        out = digits[:]
        for side, part in enumerate((range(h), range(h, len(digits)))):
            for i in reversed(part):
                value[side], out[i] = divmod(value[side], radix[i])
        return out

    def shaped(self, s: str, tweak: str) -> str:
        """``s`` with each letter and digit replaced by one of its class; hexadecimal strings stay so."""
        sets, form = [alphabet(c) for c in s], None
        if len(s) >= 8 and re.fullmatch(r"[0-9a-f]+", s) and re.search("[a-f]", s):
            sets, form = ["0123456789abcdef"] * len(s), len(s)
        place = [i for i, k in enumerate(sets) if k]
        if form is None:
            form = "".join(k[0] if k else c for k, c in zip(sets, s))
        out = list(s)
        for i, d in zip(place, self.permute([sets[i].index(s[i]) for i in place], [len(sets[i]) for i in place], f"{tweak}|{form}")):
            out[i] = sets[i][d]
        return "".join(out)

    def letters(self, n: int, *what: object) -> str:
        """``n`` random letters."""
        out: list[str] = []
        for block in itertools.count():
            if len(out) >= n:
                return "".join(out[:n])
            x = self._draw("letters", block, *what)
            for _ in range(50):
                x, i = divmod(x, 26)
                out.append(ASCII[1][i])

    def _name(self, kind: str, value: str, attempt: int, tweak: str) -> str:
        script = unicodedata.name(value[0], "LATIN").split(" ")[0]
        if script not in SYLLABLES:
            return self.shaped(value, tweak) if attempt < FREE else self.shaped(value, tweak) * (attempt - FREE + 2)
        n, parts, syllables = self._draw(tweak, value), [], SYLLABLES[script]
        for _ in range(self.syllables + attempt // 4 if attempt < FREE else 16 + attempt - FREE):
            n, i = divmod(n, len(syllables))
            parts.append(syllables[i])
        return "".join(parts) + (ENDINGS[script][kind[-1]] if kind != "family" else "")

    def _of(self, kind: str, value: str, attempt: int) -> str:
        tweak = f"{kind}|{attempt}"
        if kind == "email":
            local, domain = value.rsplit("@", 1)
            rest, top = domain.rsplit(".", 1)
            new = self.shaped(local, tweak) if attempt < FREE else self.letters(len(local) + 8 + attempt - FREE, tweak, value)
            return f"{new}@{self.shaped(rest, 'domain')}.{top}"
        if kind == "family" or kind.startswith("given:"):
            return self._name(kind, value, attempt, tweak)
        if attempt >= FREE:
            return self.letters(len(value) + 8 + attempt - FREE, tweak, value)
        if kind in SECRETS and math.prod(len(alphabet(c)) or 1 for c in value) < FORMS:
            return self.letters(len(value), tweak, value)
        if kind == "ip":
            return ".".join(map(str, self.permute([int(x) for x in value.split(".")], [256] * 4, tweak)))
        if kind == "ip6":
            places = [i for i, c in enumerate(value) if c != ":"]
            new, out = self.permute([int(value[i], 16) for i in places], [16] * len(places), f"{tweak}|{re.sub('[^:]', 'x', value)}"), list(value)
            for i, d in zip(places, new):
                out[i] = f"{d:x}"
            return "".join(out)
        if kind == "key":
            return value[:4] + self.shaped(value[4:], tweak)
        if kind == "card":
            digits = [int(c) for c in value]
            new = self.permute(digits[:-1], [10] * (len(digits) - 1), f"{tweak}|{len(digits)}")
            new.append((luhn(new) + digits[-1] - luhn(digits[:-1])) % 10)
            return "".join(map(str, new))
        if kind == "iban":
            rest = self.shaped(value[4:], f"{tweak}|{value[:2]}")
            return f"{value[:2]}{iban_check(value[:2], rest):02d}{rest}"
        if kind == "birth":
            a, b = self.permute([*divmod(datetime.date.fromisoformat(value).toordinal() - FIRST_DAY, 229)], [DAYS // 229, 229], tweak)
            return datetime.date.fromordinal(FIRST_DAY + 229 * a + b).isoformat()
        if kind == "phone":
            code = next((k for k in (1, 2) if value[1 : 1 + k] in CALLING), 3) + 1 if value.startswith("+") else 1
            return value[:code] + self.shaped(value[code:], f"{tweak}|{value[:code]}")
        return self.shaped(value, tweak)


@lru_cache(maxsize=2)
def surrogates(key: str, syllables: int = 3) -> Surrogates:
    return Surrogates(key, syllables)


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches, "text", 1024):
        found = {(k, canonical(k, v)) for t in b.column("text") for k, v, _, _ in entities(t.as_py() or "")}
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())], ["kind", "value"])


def _mapped(key: str, syllables: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Surrogates(key, syllables)
        for b in batches:
            new = [s.of(*x) for x in zip(*(b.column(c).to_pylist() for c in ("kind", "value", "attempt")))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string())], ["kind", "value", "attempt", "surrogate"])

    return of


def exceptions(docs: DataFrame, key: str, most: int = 50, syllables: int = 3) -> tuple[DataFrame, int]:
    """``kind``, ``value`` and ``attempt`` of the entities whose first surrogate collides, and the syllables of names,
    at least so many; ``most`` rounds keep the format."""
    schema = "kind string, value string, attempt int, surrogate string"
    found = docs.select(F.col("text").cast("string").alias("text")).where("text is not null").mapInArrow(_values, "kind string, value string")
    known = materialize(found.distinct(), "entities")
    names = known.where("kind = 'family' or kind like 'given:%'").count()
    while len(SYLLABLES["CYRILLIC"]) ** syllables < ROOM * names:
        syllables += 1
    now = known.withColumn("attempt", F.lit(0))
    for rounds in itertools.count(1):
        new = materialize(now.select("kind", "value", "attempt").mapInArrow(_mapped(key, syllables), schema), "surrogates")
        remove(*([now_held] if rounds > 1 else []))
        now = now_held = new
        first = now.groupBy("surrogate").agg(F.min(F.struct("attempt", "kind", "value")).alias("m"), F.count("*").alias("c")).where("c > 1").select("surrogate", "m.*")
        real = known.select(F.col("value").alias("surrogate")).distinct()
        clash = (
            now.join(first.select("surrogate", F.col("kind").alias("k"), F.col("value").alias("v")).hint("merge"), "surrogate").where("kind <> k or value <> v").select("kind", "value")
            .union(now.join(real.hint("merge"), "surrogate", "left_semi").select("kind", "value"))
            .distinct()
        )
        clash = materialize(clash, "clashes")
        if clash.isEmpty():
            remove(known, clash)
            return now.where("attempt > 0").select("kind", "value", "attempt"), syllables
        onward = F.col("attempt") + 1 if rounds < most else F.greatest(F.col("attempt") + 1, F.lit(FREE))
        now = now.join(clash.withColumn("again", F.lit(1)), ["kind", "value"], "left").select("kind", "value", F.when(F.col("again").isNull(), F.col("attempt")).otherwise(onward).alias("attempt"))


def _replaced(key: str, syllables: int, known: dict[tuple[str, str], int], own: str | None):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = surrogates(key, syllables)
        for b in sliced(batches, "text", 1024):
            texts, counts, kinds = [], [], []
            moved = b.column(own).to_pylist() if own else [None] * b.num_rows
            for t, m in zip(b.column("text"), moved):
                text = t.as_py()
                found = entities(text) if text else []
                steps = {(x["kind"], x["value"]): x["attempt"] for x in m} if m else known
                out, at = [], 0
                for kind, value, lo, hi in found:
                    plain = canonical(kind, value)
                    out += [text[at:lo], written(kind, value, s.of(kind, plain, steps.get((kind, plain), 0)))]
                    at = hi
                texts.append("".join([*out, text[at:]]) if found else text)
                counts.append(len(found))
                names = [k.split(":")[0] for k, *_ in found]
                kinds.append(",".join(f"{k}:{names.count(k)}" for k in sorted(set(names))))
            keep = [c for c in b.schema.names if c not in ("text", own)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(kinds, pa.string())], [*keep, "text", "n_entities", "kinds"])

    return of


def _found(row: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text", 1024):
            rows = [(h, k, v) for h, t in zip(b.column(row).to_pylist(), b.column("text")) for k, v in {(k, canonical(k, v)) for k, v, _, _ in entities(t.as_py() or "")}]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], [row, "kind", "value"])

    return of


def replace(docs: DataFrame, key: str, broadcast_rows: int = 20_000, syllables: int = 3) -> DataFrame:
    """``docs`` with surrogates in ``text``, plus ``n_entities`` and ``kinds`` (such as ``email:2,ip:1``).

    ``key`` decides all surrogates; whoever has it can undo the permutations, so it must be kept like a password."""
    if not key:
        raise ValueError("a key is asked for")
    columns = [c for c in docs.columns if c.lower() not in ("text", "n_entities", "kinds")]
    moved, syllables = exceptions(docs, key, syllables=syllables)
    rows = docs.select(*columns, docs["text"].cast("string").alias("text"))
    fields = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_entities", T.LongType()), T.StructField("kinds", T.StringType())])
    known: dict[tuple[str, str], int] = {}
    own = None
    if moved.count() <= broadcast_rows:  # short strings: a few MB at most
        known = {(r["kind"], r["value"]): r["attempt"] for r in moved.collect()}
    else:
        row, own = spare("row_", docs.columns), spare("moved_", docs.columns)
        rows = materialize(rows.withColumn(row, F.sha2("text", 256)), "texts")
        found = rows.select(row, "text").mapInArrow(_found(row), f"{row} string, kind string, value string")
        moves = found.join(moved, ["kind", "value"]).distinct().groupBy(row).agg(F.collect_list(F.struct("kind", "value", "attempt")).alias(own))
        often = hot_keys(rows.where(F.col(row).isNotNull()).groupBy(row).agg(F.count("*").alias("c")), [row], "c", rows.count())
        rows = spread_join(rows, moves, [row], often, "left").drop(row)  # a common text goes to several tasks
    new = rows.mapInArrow(_replaced(key, syllables, known, own), schema)
    return new.select(*[c for c in docs.columns if c.lower() not in ("n_entities", "kinds")], "n_entities", "kinds")


#: For queries over test tables only; real data needs a secret one.
TEST_KEY = "key-for-test-tables"


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace(table(spark, sf_dir, "documents").select("doc_id", "text"), spark.conf.get("spark.llm.pii.key", TEST_KEY))
