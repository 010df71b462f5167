"""Surrogates for personal data: keyed, type-consistent replacements.

Detected: e-mail addresses, IPv4 and IPv6 addresses, payment cards (issuer prefix and
Luhn digit), IBANs (check digits), US social security numbers, phone numbers (with a
country code, in groups, in pairs, or plain after a cue such as ``Tel.``), secrets
assigned to a name such as ``token``, and person names after a title, after a cue such
as ``name:``, below a sign-off, before an e-mail address in angle brackets, or led by a
known given name (and their other mentions in the same text).  A surrogate keeps the
entity's type, length, separators, letter case, script and validity (Luhn, check
digits, octet range, gender of given names); it is a function of the key, the type, the
entity's normal form and, for given names, their gender over all documents (both
genders seen: a name of either), so mentions of one entity agree in every document,
whatever the title or the way a number is written.

Distinct entities get distinct surrogates, and no surrogate equals an entity found
anywhere in the corpus: all distinct entities are gathered by shuffle, each takes
its first surrogate, and whoever loses a clash (the smaller normal form wins) takes
its next, until no clash is left.  Later choices grow longer every few attempts, so a
name space that the corpus uses up still ends.  Only those choices and the genders
travel back to their documents; the rest follows from the key alone.

Defined results: a null text stays null with 0 entities; texts without entities are
unchanged; overlapping finds go to the type listed first; rows equal in id and text
give equal rows; null ids are allowed; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sacctlens.llm.common import materialize

KEY = b"change-me"

# Titles by gender, given names by gender and script, syllables of
# made-up names by script, issuer prefixes, reserved domains.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Sr", "Señor", "Don", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Sra", "Señora", "Doña", "Госпожа", "Κυρία"),
    "n": ("Dr", "Prof"),
}
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Oscar", "Paul", "Simon", "Victor"),
    ("latin", "f"): ("Alice", "Bianca", "Clara", "Diana", "Emma", "Flora", "Helena", "Irene", "Julia", "Laura", "Maria", "Nina", "Olga", "Paula", "Sara", "Vera"),
    ("latin", "n"): ("Alex", "Andrea", "Chris", "Dominique", "Kim", "Maxime", "Robin", "Sam"),
    ("cyrillic", "m"): ("Алексей", "Борис", "Виктор", "Дмитрий", "Иван", "Максим", "Олег", "Павел"),
    ("cyrillic", "f"): ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Софья"),
    ("cyrillic", "n"): ("Женя", "Саша", "Валя", "Никита"),
    ("greek", "m"): ("Ανδρέας", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"),
    ("greek", "f"): ("Άννα", "Ελένη", "Κατερίνα", "Μαρία", "Σοφία", "Χριστίνα"),
    ("greek", "n"): ("Αλέξης", "Μιχάλης"),
}
SYLLABLES = {
    "latin": ("ba", "den", "fi", "gor", "hal", "ker", "lin", "mar", "nor", "pel", "ros", "sal", "tor", "ver", "wen", "zan"),
    "cyrillic": ("ба", "ден", "гор", "кар", "лин", "мар", "нор", "пет", "рос", "сал", "тор", "вер"),
    "greek": ("βα", "δεν", "γορ", "καρ", "λιν", "μαρ", "νορ", "πετ", "ροσ", "σαλ", "τορ", "φερ"),
}
ENDINGS = {"latin": {"m": "o", "f": "a", "n": "e"}, "cyrillic": {"m": "ий", "f": "а", "n": "я"}, "greek": {"m": "ος", "f": "α", "n": "ης"}}
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[4-8]|6(?:011|4|5)")
RESERVED = re.compile(r"(?:^|\.)(?:example\.(?:com|net|org)|example|test|invalid)$")
# Country calling codes of one and two digits (all others have three);
# cues of names and phone numbers; sign-offs.
SHORT_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54",
               "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98")
NAME_CUES = ("name", "nom", "nombre", "author", "auteur", "autor")
PHONE_CUES = ("tel", "tél", "phone", "telephone", "téléphone", "telefon", "teléfono", "mobile", "móvil", "cell", "handy", "fax", "whatsapp")
SIGN_OFFS = ("regards", "sincerely", "cordialement", "grüßen", "saludos", "atentamente")
#: Attempts after which a surrogate may be one character longer.
GROW = 4

_WORD = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_TITLE = {t: g for g, ts in TITLES.items() for t in ts}
PATTERNS = (
    ("email", re.compile(r"(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)+")),
    ("ip", re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)")),
    ("ipv6", re.compile(r"(?<![\w:.])(?=[0-9a-fA-F:]{0,39}:[0-9a-fA-F]{0,4}:)[0-9a-fA-F:]{4,39}(?<!:)(?![\w:])")),
    ("secret", re.compile(r"(?i)\b(?:token|secret|api[_-]?key|password|passwd)\b[\"']?\s*[=:]\s*[\"']?([\w+/-]{8,})")),
    ("secret", re.compile(r"\b(AKIA[0-9A-Z]{16})\b")),
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("card", re.compile(r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\w)")),
    ("phone", re.compile(r"(?<![\w+])\+[1-9](?:[ .()/-]{0,2}\d){7,14}(?!\w)")),
    ("phone", re.compile(r"(?<![\w+.,-])(?:0\d(?:[ .-]\d\d){4}|[6-9]\d\d(?:[ .-]\d\d){3}|0\d{2,4}[ /-]\d{5,8})(?![\w-]|[.,]\d)")),
    ("phone", re.compile(rf"(?i)(?<!\w)(?:{'|'.join(PHONE_CUES)})(?:\.:?|:)?[ ]?(0?[1-9]\d{{6,11}})(?!\w)")),
)
_NAMES = rf"{_WORD}(?:[ ]{_WORD}){{0,2}}"
TITLED = re.compile(rf"(?<!\w)({'|'.join(sorted(_TITLE, key=len, reverse=True))})\.?[ ]({_NAMES})")
CUED = re.compile(rf"(?<!\w)(?i:{'|'.join(NAME_CUES)})[ ]?:[ ]?({_NAMES})")
SIGNED = re.compile(rf"(?i:{'|'.join(SIGN_OFFS)})[,.!]?[ ]*\n\s{{0,8}}({_NAMES})[ ]*(?:\n|$)")
_BRACKET = re.compile(r" <(?=[\w.+%-]+@)")
_BEFORE = re.compile(rf"(?<!\w){_NAMES}$")
#: Genders of the known given names; those of several genders have either.
KNOWN: dict[str, str] = {}
for (_, _gender), _some in GIVEN.items():
    for _one in _some:
        KNOWN[_one] = _gender if KNOWN.get(_one, _gender) == _gender else "n"
LED = re.compile(rf"(?<!\w)((?:{'|'.join(sorted(KNOWN, key=len, reverse=True))})[ ]{_WORD})")
_HINTS = tuple(f"{t}{end}" for t in _TITLE for end in (" ", ". "))
_CUE_HINTS = tuple(f"{c}{end}" for w in NAME_CUES for c in (w, w.title(), w.upper()) for end in (":", " :"))
_SIGN_HINTS = tuple(c for w in SIGN_OFFS for c in (w, w.title(), w.upper()))
_DIGIT = re.compile(r"\d")
_SECRET_HINT = re.compile(r"(?i)token|secret|key|passw")


def luhn(digits: str) -> bool:
    rev = [int(c) for c in reversed(digits)]
    return (sum(rev[::2]) + sum(sum(divmod(2 * d, 10)) for d in rev[1::2])) % 10 == 0


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def script_of(word: str) -> str:
    name = unicodedata.name(word[0], "")
    return next((s for s in ("cyrillic", "greek") if name.startswith(s.upper())), "latin")


def normal(kind: str, found: str) -> str:
    """The form that all mentions of an entity share."""
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", found)
    if kind == "phone":                       # without country code and trunk zeros
        digits = re.sub(r"\D", "", found)
        if found.startswith("+"):
            digits = digits[next((n for n in (1, 2) if digits[:n] in SHORT_CODES), 3):]
        elif len(digits) == 11 and digits[0] == "1":
            digits = digits[1:]
        return digits.lstrip("0") or "0"
    if kind == "ipv6":
        return ipaddress.IPv6Address(found).compressed
    if kind == "iban":
        return found.replace(" ", "")
    if kind == "secret":
        return found.lower() if re.fullmatch(r"[0-9a-fA-F]+", found) else found
    return found.lower()


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(int(x) < 256 for x in found.split("."))
    if kind == "card":
        digits = re.sub(r"\D", "", found)
        return bool(ISSUERS.match(digits)) and luhn(digits)
    if kind == "iban":
        return iban_rest(found.replace(" ", "")) == 1
    if kind == "secret":
        return bool(_DIGIT.search(found))
    if kind == "ipv6":
        try:
            got = ipaddress.IPv6Address(found)
        except ValueError:
            return False
        return bool(_DIGIT.search(found)) and not (got.is_loopback or got.is_unspecified) and re.search(r"\w{3}", found) is not None
    return True


def entity(kind: str) -> str:
    """The kind that names an entity: given names are one entity whatever the gender."""
    return kind.rpartition(":")[0] if kind.startswith("given") else kind


def _named(text: str) -> Iterator[tuple[str, int, int, int]]:
    """(gender, start, end, fewest words) of what may be a person's name."""
    if any(h in text for h in _HINTS):
        for m in TITLED.finditer(text):
            yield _TITLE[m[1]], *m.span(2), 1
    if any(h in text for h in _CUE_HINTS):
        for m in CUED.finditer(text):
            yield "n", *m.span(1), 2
    if any(h in text for h in _SIGN_HINTS):
        for m in SIGNED.finditer(text):
            yield "n", *m.span(1), 2
    if "@" in text:
        for m in _BRACKET.finditer(text):
            low = max(0, m.start() - 80)
            before = _BEFORE.search(text[low:m.start()])
            if before:
                yield "n", low + before.start(), m.start(), 2
    for m in LED.finditer(text):
        yield "n", *m.span(1), 2


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normal form) of the entities of a text, in order."""
    digits = _DIGIT.search(text) is not None
    out: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []

    def add(start: int, end: int, kind: str) -> None:
        at = bisect.bisect(taken, (start, end))
        if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or end <= taken[at][0]):
            taken.insert(at, (start, end))
            out.append((start, end, kind, normal(kind.partition(":")[0], text[start:end])))

    for kind, pattern in PATTERNS:
        if "@" not in text if kind == "email" else not digits or (kind == "secret" and not _SECRET_HINT.search(text) and "AKIA" not in text):
            continue
        for m in pattern.finditer(text):
            start, end = m.span(1) if pattern.groups else m.span()
            if kind == "email":
                while text[end - 1] in ".-_":
                    end -= 1
                while text[start] in ".-%+":
                    start += 1
            if _valid(kind, text[start:end]):
                add(start, end, kind)
    words: dict[str, str] = {}
    for gender, start, end, fewest in _named(text):
        parts = []
        for w in re.finditer(_WORD, text[start:end]):
            if not w[0][0].isupper() or len(w[0]) < 2:
                break
            parts.append(w)
        if len(parts) < fewest:
            continue
        for i, w in enumerate(parts):
            own = KNOWN.get(w[0].title(), "n") if gender == "n" else gender
            kind = f"given:{script_of(w[0])}:{own}" if i < len(parts) - 1 else f"family:{script_of(w[0])}"
            words.setdefault(w[0], kind)
            add(start + w.start(), start + w.end(), kind)
    if words:                                 # other mentions
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(words, key=len, reverse=True)))})(?!\w)", text):
            add(m.start(), m.end(), words[m[0]])
    return sorted(out)


class Stream:
    """Numbers drawn from a keyed hash."""

    def __init__(self, key: bytes, *what: str):
        self.key, self.what, self.n, self.pool = key, "\x1f".join(what), 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 64:
            block = hmac.new(self.key, f"{self.what}\x1f{self.n}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
            self.pool, self.left, self.n = int.from_bytes(block, "big"), 256, self.n + 1
        self.pool, got = divmod(self.pool, 1 << 32)
        self.left -= 32
        return got * n >> 32


def _classwise(text: str, s: Stream, keep: int = 0, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    """Digits for digits, letters for letters of the same case, anything else as it is."""
    out = [text[:keep]]
    for c in text[keep:]:
        if c.isdigit():
            out.append(str(s.below(10)))
        elif c.isalpha():
            x = letters[s.below(len(letters))]
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, norm: str, attempt: int = 0, gender: str = "n") -> str:
    """The surrogate's normal form; ``kind`` as ``entity`` gives it, ``gender`` for given names."""
    s = Stream(key, kind, norm, str(attempt))
    more = "0" * (attempt // GROW)
    if kind == "email":
        local, _, domain = norm.rpartition("@")
        if not RESERVED.search(domain):
            *labels, last = domain.split(".")
            one = Stream(key, "domain", domain)
            domain = ".".join([_classwise(x, one) for x in labels] + [last])
        return f"{_classwise(local + 'x' * len(more), s)}@{domain}"
    if kind == "ip" and attempt < GROW:
        low = {1: (1, 9), 2: (10, 90), 3: (100, 155)}
        return ".".join(str(low[len(x)][0] + s.below(low[len(x)][1])) for x in norm.split("."))
    if kind == "ip" and attempt < 2 * GROW:
        return ".".join(str(1 + s.below(n)) for n in (223, 254, 254, 254))
    if kind in ("ip", "ipv6"):                # an address keeps its first group, or becomes one for documentation
        head = int(ipaddress.IPv6Address(norm)) >> 112 if kind == "ipv6" else 0x2001
        groups = [head] + ([0xDB8] if head == 0x2001 else [])
        while len(groups) < 8:
            groups.append(s.below(1 << 16))
        return ipaddress.IPv6Address(":".join(f"{g:x}" for g in groups)).compressed
    if kind == "card":
        head = _classwise(norm[:-1] + more, s, keep=ISSUERS.match(norm).end())
        return next(head + d for d in "0123456789" if luhn(head + d))
    if kind == "ssn":
        return "9" + _classwise(norm[1:] + more, s)
    if kind == "phone":
        got = _classwise(norm, s, keep=1)
        if norm[-7:-4] == "555" and len(norm) > 7:
            got = got[:-7] + "555" + got[-4:]
        return got + _classwise(more, s)
    if kind == "iban":
        body = _classwise(norm[4:] + more, s)
        return norm[:2] + f"{98 - iban_rest(norm[:2] + '00' + body):02d}" + body
    if kind == "secret":
        hexed = re.fullmatch(r"[0-9a-f]+", norm) is not None
        return _classwise(norm + more, s, keep=4 if norm.startswith("AKIA") else 0, letters="abcdef" if hexed else "abcdefghijklmnopqrstuvwxyz")
    sort, _, script = kind.partition(":")
    if sort == "given" and attempt == 0:
        names = GIVEN[(script, gender)]
        return names[s.below(len(names))].lower()
    made = "".join(SYLLABLES[script][s.below(len(SYLLABLES[script]))] for _ in range(2 + attempt // 2))
    return made + (ENDINGS[script][gender] if sort == "given" else "")


def render(kind: str, found: str, norm: str, new: str) -> str:
    """The surrogate in the format of one mention."""
    if kind.startswith(("given", "family")):
        return new.upper() if found.isupper() and len(found) > 1 else new[:1].upper() + new[1:]
    if kind in ("ssn", "card", "phone", "iban"):
        chars = iter(new)
        skip = sum(c.isalnum() for c in found) - len(new)
        out = []
        for c in found:
            if not c.isalnum():
                out.append(c)
            elif skip > 0:
                skip -= 1
                out.append(c)
            else:
                out.append(next(chars))
        return "".join(out) + "".join(chars)
    if kind == "secret" and found == norm or len(found) != len(new):
        return new
    return "".join(n.upper() if f.isupper() else n for f, n in zip(found, new))


def replace(text: str, key: bytes, later: dict[tuple[str, str], tuple[int, str]]) -> tuple[str, int]:
    """The text with surrogates, and how many; ``later`` has attempts above 0 and genders
    of given names, which otherwise follow from the text alone."""
    out, at, spans = [], 0, find(text)
    seen: dict[tuple[str, str], set[str]] = {}
    for _, _, kind, norm in spans:
        seen.setdefault((entity(kind), norm), set()).add(kind.rpartition(":")[2])
    for start, end, kind, norm in spans:
        one = (entity(kind), norm)
        attempt, gender = later.get(one) or (0, joint(seen[one]) if kind.startswith("given") else "n")
        out += (text[at:start], render(kind, text[start:end], norm, surrogate(key, one[0], norm, attempt, gender)))
        at = end
    return "".join(out) + text[at:], len(spans)


def joint(genders: set[str]) -> str:
    """The gender that all mentions agree on: ``n`` where they show none or both."""
    return "n" if ("m" in genders) == ("f" in genders) else "m" if "m" in genders else "f"


def mentions(docs: DataFrame) -> DataFrame:
    """doc_id, check, kind, norm, gender: the distinct entities of each document."""
    names = ["doc_id", "check", "kind", "norm", "gender"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids, checks = batch.column("doc_id"), batch.column("check")
            for i, text in enumerate(batch.column("text")):
                if text.is_valid:
                    rows += [(ids[i].as_py(), checks[i].as_py(), entity(k), n, k.rpartition(":")[2] if k.startswith("given") else None)
                             for k, n in sorted({(k, n) for _, _, k, n in find(text.as_py())})]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return docs.mapInArrow(found, "doc_id long, check long, kind string, norm string, gender string")


def assign(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """kind, norm, gender, attempt, sur for each (kind, norm) of ``entities`` (kind, norm, gender):
    no two share a sur, no sur is a norm.

    A round judges only the entities without a surrogate yet; those of earlier rounds keep theirs.
    """
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.to_pydict()
            sur = [surrogate(key, k, n, a, g) for k, n, g, a in zip(d["kind"], d["norm"], d["gender"], d["attempt"])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sur, pa.string())], names=[*batch.schema.names, "sur"])

    # Given names clash across scripts too; a kind's first word is its name space, and all addresses of hosts are one.
    space = F.regexp_replace(F.substring_index("kind", ":", 1), "ipv6", "ip")
    pick = lambda df: materialize(df.select("kind", "norm", "gender", "attempt").mapInArrow(
        chosen, "kind string, norm string, gender string, attempt int, sur string").withColumn("space", space))
    male, female = (F.coalesce(F.max(F.col("gender") == g), F.lit(False)) for g in "mf")
    one = entities.groupBy("kind", "norm").agg(F.when(male == female, "n").when(male, "m").otherwise("f").alias("gender"))
    taken = materialize(one.select(space.alias("space"), F.col("norm").alias("sur")).distinct())
    fresh, settled = pick(one.withColumn("attempt", F.lit(0))), None
    while True:
        first = (fresh.groupBy("space", "sur").agg(F.min(F.struct("norm", "kind")).alias("first"))
                 .join(taken, ["space", "sur"], "left_anti"))
        judged = materialize(fresh.join(first, ["space", "sur"], "left")
                             .withColumn("won", F.coalesce(F.struct("norm", "kind") == F.col("first"), F.lit(False))).drop("first"))
        won, lost = judged.filter("won").drop("won"), judged.filter("not won").drop("won")
        settled = won if settled is None else settled.unionByName(won)
        if lost.isEmpty():
            return settled.drop("space")
        taken = taken.unionByName(won.select("space", "sur"))
        fresh = pick(lost.withColumn("attempt", F.col("attempt") + 1))


def pseudonymise(docs: DataFrame, key: bytes = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (with surrogates), n_entities: one row per row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("check"), F.col(text_col).alias("text"))
    held = materialize(mentions(texts))
    later = (assign(held.select("kind", "norm", "gender").distinct(), key).filter("attempt > 0 or kind like 'given%'")
             .select("kind", "norm", "attempt", "gender"))
    per_doc = (held.drop("gender").join(later, ["kind", "norm"]).groupBy("doc_id", "check")
               .agg(F.collect_set(F.struct("kind", "norm", "attempt", "gender")).alias("later")).withColumnsRenamed({"doc_id": "_id", "check": "_check"}))
    joined = texts.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("check") == F.col("_check")), "left").select("doc_id", "text", "later")

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, counts = [], []
            for text, later in zip(batch.column("text"), batch.column("later")):
                if not text.is_valid:
                    out.append(None)
                    counts.append(0)
                    continue
                more = {(x["kind"], x["norm"]): (x["attempt"], x["gender"]) for x in later.as_py() or ()}
                new, n = replace(text.as_py(), key, more)
                out.append(new)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string()), pa.array(counts, pa.int64())], names=["doc_id", "text", "n_entities"])

    return joined.mapInArrow(replaced, "doc_id long, text string, n_entities long")
