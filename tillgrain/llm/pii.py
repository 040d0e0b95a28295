"""Personal data replaced by keyed surrogates of the same kind and format.

Detected: e-mail addresses, phone numbers, IPv4 and IPv6 addresses, card numbers, IBANs, US social
security numbers, access keys and secrets (`password=...`), and person names: after a title, a
known given name before a surname, or two names after a phrase like "my name is".

Every kind goes through a keyed permutation of all strings of its format (letters stay letters of
their case, digits digits, signs stay), so two entities never get one surrogate and an entity always
gets the same, in every document and whatever else the corpus holds.  Check digits of cards are
right, those of IBANs as right or wrong as they were.  Known given names are permuted within their
gender and script; other names letter by letter (vowels stay vowels, marked letters marked ones),
walking on past the known given names.  `collisions` counts the surrogates that stand for several names.

A name's surrogate follows from the word alone, not from its role.  Once a person is found in a text,
every capitalised mention of that person's names there is replaced, also possessives, upper case and parts of
double names; a word that is spelled like one of these names is taken for a mention, too.
A lone given name without a surname in its text is no person.

Null texts stay null, empty texts and texts without entities stay as they are; equal texts become
equal texts; long texts are read whole, in time linear in their length.
"""

from __future__ import annotations

import functools
import hashlib
import ipaddress
import math
import re

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from .common import free_name

# Titles, offices that follow a title, small words inside names, phrases before a name.
TITLES = ("Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Señor Señora Sr Sra Signor Signora "
          "Господин Госпожа").split()
OFFICES = ("President Speaker Chairman Chairwoman Minister Chancellor Secretary Justice Mayor Governor "
           "Präsident Kanzler Kanzlerin Minister Président Ministre Presidente Ministro").split()
PARTICLES = "van von der den de del della da di la le du dos bin al el".split()
PHRASES = ["my name is", "name:", "dear", "signed by", "sincerely,", "regards,", "attn:", "attention:"]
# Common given names by gender and script; a name is replaced by one of its own list.
GIVEN = {
    "male": ("James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew "
             "Peter Paul Mark George Andrew Anthony Bob Brian Edward Frank Henry Jack Kevin Steven "
             "Hans Klaus Jürgen Stefan Wolfgang Karl Pierre Jacques Michel Luc François Juan Carlos "
             "José Luis Miguel Pedro Javier Marco Luca Giovanni Paolo Ivan Sergei Dmitri "
             "Ahmed Mohammed Omar Ali Wei Ming Hiroshi Kenji Raj Arjun Vikram Kwame").split(),
    "female": ("Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa "
               "Margaret Emily Laura Emma Anna Alice Catherine Helen Julia Kate Rachel Ruth Sandra "
               "Ursula Monika Sabine Petra Heike Marie Nathalie Isabelle Sophie Camille María Carmen "
               "Ana Lucía Elena Rosa Giulia Chiara Francesca Paola Olga Natalia Tatiana "
               "Fatima Aisha Leila Mei Ling Yuki Keiko Priya Ananya Lakshmi Amina").split(),
    "male, Cyrillic": ("Иван Сергей Дмитрий Александр Алексей Андрей Михаил Николай Павел Пётр "
                       "Владимир Игорь Олег Юрий Максим Антон").split(),
    "female, Cyrillic": ("Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия "
                         "Людмила Галина Вера Надежда Дарья Софья").split(),
}
# Letters that stand for each other in names (others: letters of their 64 code points).
KINDS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "áàâäãåéèêëíìîïóòôöõúùûüýæøœ", "çñšžćčđłńśźřť",
         "аеиоуыэюяё", "бвгджзйклмнпрстфхцчшщ", "ьъ", "αεηιουω", "άέήίόύώ", "βγδζθκλμνξπρτφχψ"]
_kinds = {ch: kind for kind in KINDS for ch in kind}
_listed = {name.lower(): (group, k) for group, names in GIVEN.items() for k, name in enumerate(names)}

_patterns = [
    ("email", r"(?<![\w.%+\-])[\w.%+\-]+@[\w\-]+(?:\.[\w\-]+)*\.[^\W\d_]{2,}"),
    ("key", r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\b(?:ghp_|sk_live_|sk-)[A-Za-z0-9]{16,}\b"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key))\s*[=:]\s*(?:\"[^\"\s]{6,}\"|'[^'\s]{6,}'|[^\s\"',;]{6,})"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)"),
    ("ip6", r"(?<![\w:.])(?:[23][0-9A-Fa-f]{3}|[Ff][CcDd][0-9A-Fa-f]{2}|[Ff][Ee][89ABab][0-9A-Fa-f])"
            r"(?::[0-9A-Fa-f]{1,4}){0,7}(?:::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)?(?![\w:])"),
    ("card", r"(?<![\d.])\d(?:[ -]?\d){12,18}(?!\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
              r"|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"),
]
_entity = re.compile("|".join(f"(?P<{name}>{p})" for name, p in _patterns))
_mark = re.compile("[0-9@]")
_name = r"(?:\p{Lu}['’])?\p{Lu}[\p{L}\p{M}]+"
_mention = regex.compile(rf"(?<![\p{{L}}\p{{M}}]){_name}")
_full = rf"{_name}(?:-{_name})*"
_rest = rf"(?:\p{{Lu}}\. ?){{0,3}}(?:(?:{'|'.join(PARTICLES)})[ \u00a0]+){{0,3}}(?P<last>{_full})"
_gap = r"[ \u00a0]+"
_known = r"(?P<given>\L<known>)"
_person = regex.compile(
    rf"(?<![\p{{L}}\p{{M}}])(?:\L<titles>\b\.?{_gap}(?!\L<offices>\b)(?:(?P<given>{_full}){_gap})?{_rest}"
    rf"|{_known}{_gap}(?:{_known}{_gap})?{_rest}"
    rf"|(?i:{'|'.join(map(re.escape, PHRASES))})\s+(?!\L<titles>\b)(?P<given>{_full}){_gap}{_rest})",
    titles=TITLES + [t.upper() for t in TITLES], offices=OFFICES + [o.upper() for o in OFFICES],
    known=[n for names in GIVEN.values() for name in names for n in (name, name.upper())])
_capital = re.compile(r"(?<![^\W\d_])([^\W\d_a-z][^\W\d_]+)\.?[ \u00a0]+(?=[^\W\d_])")
_leads = {n for names in (TITLES, *GIVEN.values()) for name in names for n in (name, name.upper())}
_words = ("akia", "asia", "ghp_", "sk_live_", "sk-", "passw", "pwd", "secret", "token", "api")


def _may_hold(line: str) -> bool:
    """Whether a line can hold an entity other than a name."""
    if _mark.search(line):
        return True
    low = line.lower()
    return any(w in low for w in _words)


def _may_name(text: str) -> bool:
    low = text.lower()
    return any(p in low for p in PHRASES) or any(m[1] in _leads for m in _capital.finditer(text))


def _draw(key: str, *parts) -> int:
    said = "\x1f".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(said, key=key.encode()[:64], digest_size=16).digest(), "big")


def _feistel(x: int, size: int, key: str, name: str, back: bool) -> int:
    """A keyed permutation of 0..size-1: Feistel rounds, walked until inside."""
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    while True:
        left, right = divmod(x, b)
        for r in (range(5, -1, -1) if back else range(6)):
            if r % 2 == 0:
                step = _draw(key, name, size, r, right) % a
                left = (left - step if back else left + step) % a
            else:
                step = _draw(key, name, size, r, left) % b
                right = (right - step if back else right + step) % b
        x = left * b + right
        if x < size:
            return x


def moved(x: int, size: int, key: str, name: str) -> int:
    """A keyed permutation that leaves nothing in place (from two values on)."""
    return _feistel((_feistel(x, size, key, name, True) + 1) % size, size, key, name, False)


@functools.lru_cache(4096)
def _kind(ch: str) -> str:
    """Lower-case letters that may stand for `ch`, a lower-case letter; else `ch` alone."""
    if ch in _kinds:
        return _kinds[ch]
    if not _plain(ch):
        return ch
    start = ord(ch) // 64 * 64
    return "".join(c for c in map(chr, range(start, start + 64)) if _plain(c) and c not in _kinds)


def _plain(ch: str) -> bool:
    """A letter that is its own lower case and has one letter, and a way back, as upper case."""
    return ch.isalpha() and ch.lower() == ch and len(ch.upper()) == 1 and ch.upper().lower() == ch


def _low(ch: str) -> str:
    """Lower case where the way back is the same letter."""
    low = ch.lower()
    return low if len(low) == 1 and low.upper() == ch else ch


def _permuted(text: str, sets: list[str], key: str, name: str) -> str:
    """Another string whose characters come from the same sets."""
    size, x = 1, 0
    for ch, some in zip(text, sets):
        size, x = size * len(some), x * len(some) + some.index(ch)
    if size == 1:
        return text
    y, out = moved(x, size, key, f"{name}:{'|'.join(sets)}"), []
    for some in reversed(sets):
        y, digit = divmod(y, len(some))
        out.append(some[digit])
    return "".join(reversed(out))


def _letters(text: str, key: str, name: str, firsts: bool = False) -> str:
    """Permutes all strings of a format: classes of characters stay, signs stay."""
    hexa = re.fullmatch(r"[0-9a-f]+", text) and re.search("[0-9]", text) and len(text) >= 6
    sets = []
    for k, ch in enumerate(text):
        if ch.isdigit() and ch.isascii():
            lead = firsts and (k == 0 or not text[k - 1].isdigit()) and text[k + 1:k + 3].isdigit()
            sets.append("23456789" if lead and ch > "1" else "01" if lead else "0123456789")
        elif "a" <= ch <= "z":
            sets.append("abcdef" if hexa else "abcdefghijklmnopqrstuvwxyz")
        elif "A" <= ch <= "Z":
            sets.append("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
        elif ch.isalpha():
            low = _low(ch)
            sets.append(_kind(low) if low == ch else _kind(low).upper())
        else:
            sets.append(ch)
    return _permuted(text, sets, key, name)


def _luhn(digits: str) -> int:
    """The check digit that would follow."""
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = int(ch) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _spaced(digits: str, like: str) -> str:
    rest = iter(digits)
    return "".join(next(rest) if ch.isalnum() else ch for ch in like)


def _card(text: str, key: str) -> str:
    digits = re.sub(r"\D", "", text)
    body = digits[0] + _letters(digits[1:-1], key, "card" + digits[0])
    return _spaced(body + str(_luhn(body)), text)


def _iban(text: str, key: str) -> str:
    flat = text.replace(" ", "")

    def check(country, body):
        number = "".join(str(int(c, 36)) for c in body + country + "00")
        return 98 - int(number) % 97
    off = (int(flat[2:4]) - check(flat[:2], flat[4:])) % 100
    body = _letters(flat[4:], key, "iban" + flat[:2])
    return _spaced(f"{flat[:2]}{(check(flat[:2], body) + off) % 100:02d}{body}", text)


def _ip_class(x: int) -> tuple:
    a, b = x >> 24, x >> 16 & 255
    if a in (0, 10, 127) or a >= 224:
        return (a,)
    return (a, b) if (a, b) in ((192, 168), (169, 254)) or (a == 172 and 16 <= b < 32) else ()


def _ip(text: str, key: str) -> str:
    x = 0
    for part in text.split("."):
        x = x << 8 | int(part)
    kind, y = _ip_class(x), x
    while True:                     # walk on until an address of the same class
        y = moved(y, 1 << 32, key, "ip") if not kind else \
            y >> 16 << 16 | moved(y & 65535, 1 << 16, key, f"ip{kind}")
        if _ip_class(y) == kind:
            return ".".join(str(y >> s & 255) for s in (24, 16, 8, 0))


def _email(text: str, key: str) -> str:
    local, _, domain = text.rpartition("@")
    *labels, top = domain.split(".")
    return f"{_letters(local, key, 'local')}@{'.'.join(_letters(x, key, 'label') for x in labels)}.{top}"


def _secret(text: str, key: str) -> str:
    found = re.match(r"(.*?[=:]\s*[\"']?)(.*?)([\"']?)$", text, re.S)
    return found[1] + _letters(found[2], key, "secret") + found[3]


def _key(text: str, key: str) -> str:
    lead = re.match(r"AKIA|ASIA|ghp_|sk_live_|sk-", text)[0]
    return lead + _letters(text[len(lead):], key, lead)


def _ip6(text: str, key: str) -> str:
    """The first group and the zeros stay; spellings of one address get spellings of one surrogate."""
    short = ipaddress.IPv6Address(text).compressed
    lead, rest = short[:4], short[4:]
    sets = [ch if ch == ":" else "0" if ch == "0" and first else "123456789abcdef" if first else "0123456789abcdef"
            for ch, first in zip(rest, [True, *(ch == ":" for ch in rest)])]
    made = ipaddress.IPv6Address(lead + _permuted(rest, sets, key, "ip6" + lead))
    if "::" not in text and "::" in short:
        made = made.exploded if re.search(r"(?i)\b0[0-9a-f]{3}\b", text) else ":".join(
            f"{int(part, 16):x}" for part in made.exploded.split(":"))
    return str(made).upper() if text.upper() == text else str(made)


def folded(word: str) -> str:
    """What the mentions of a name have in common: lower case, one kind of apostrophe."""
    return "".join(map(_low, word.replace("’", "'")))


@functools.lru_cache(100_000)
def name_surrogate(name: str, key: str) -> str:
    """Another name for a folded one; two names never share it.

    Known given names move within their list, all others among the names of their letter kinds
    without the known ones.
    """
    if name in _listed:
        group, k = _listed[name]
        return GIVEN[group][moved(k, len(GIVEN[group]), key, group)].lower()
    sets, made = [_kind(ch) for ch in name], name
    while True:
        made = _permuted(made, sets, key, "name")
        if made not in _listed:
            return made


def _as(made: str, like: str) -> str:
    """`made` with the case and the apostrophes of `like`."""
    if like.isupper():
        return "".join(ch.upper() if len(ch.upper()) == 1 else ch for ch in made.replace("'", "’" if "’" in like else "'"))
    if len(made) != len(like):
        return made[:1].upper() + made[1:]
    return "".join(b if b == "’" else a.upper() if b.isupper() else a for a, b in zip(made, like))


class Replacer:
    def __init__(self, key: str):
        self.key = key
        self.makes = {"email": _email, "key": _key, "secret": _secret, "iban": _iban, "ip": _ip,
                      "ip6": _ip6, "card": _card,
                      "ssn": lambda t, k: _letters(t, k, "ssn"),
                      "phone": lambda t, k: re.sub(r"^(\+\d{1,3}(?=\D)|)(.*)$", lambda m: m[1] + _letters(
                          m[2], k, "phone" + m[1], True), t, flags=re.S)}
        self.count = 0

    def _entity(self, m: re.Match) -> str:
        kind, text = m.lastgroup, m[0]
        if kind == "card":
            digits = re.sub(r"\D", "", text)
            if digits[0] not in "23456" or _luhn(digits[:-1]) != int(digits[-1]):
                return text                 # a long number that is no card
        if kind == "iban" and (len(text.replace(" ", "")) < 15 or not re.search(r"\d{6}", text.replace(" ", ""))):
            return text
        if kind == "ip6":
            try:
                ipaddress.IPv6Address(text)
            except ValueError:
                return text
        self.count += 1
        return self.makes[kind](text, self.key)

    def _names(self, text: str) -> str:
        """Every mention of the names of the persons found in the text is replaced."""
        persons = list(_person.finditer(text))
        if not persons:
            return text
        names = {folded(word) for m in persons for word in _persons_words(m)}
        inside = {at for m in persons for at in range(*m.span())}
        self.count += len(persons)

        def mention(m):
            name = folded(m[0])
            if name not in names:
                return m[0]
            self.count += m.start() not in inside
            return _as(name_surrogate(name, self.key), m[0])
        return _mention.sub(mention, text)

    def replace(self, text: str) -> tuple[str, int]:
        """The text with surrogates, and how many there are."""
        self.count = 0
        if _may_hold(text):          # entities do not reach over a line's end
            text = "\n".join(_entity.sub(self._entity, line) if _may_hold(line) else line
                             for line in text.split("\n"))
        if _may_name(text):
            text = self._names(text)
        return text, self.count


def _persons_words(m) -> list[str]:
    return [w[0] for part in m.captures("given") + m.captures("last") for w in _mention.finditer(part)]


def person_names(texts: DataFrame) -> DataFrame:
    """The distinct folded names (column `name`) of the persons found in the column `text`."""
    def found(frames):
        for frame in frames:
            names = {folded(w): 1 for text in frame["text"] if _may_name(text)
                     for m in _person.finditer(text) for w in _persons_words(m)}
            yield pd.DataFrame({"name": list(names)}, dtype=object)
    return texts.filter("text is not null").select("text").mapInPandas(found, "name string").distinct()


def collisions(names: DataFrame, key: str) -> DataFrame:
    """Surrogates (column `made`) that several rows of the distinct `name` share, or that is the name itself.

    None does, as the replacement is a permutation without fixed points; this holds it against a corpus.
    A format that has one string only (no letter that another may stand for) is reported.
    """
    @F.pandas_udf("string")
    def made(name: pd.Series) -> pd.Series:
        return name.map(lambda n: name_surrogate(n, key))
    return names.select("name", made("name").alias("made")).groupBy("made").agg(
        F.count("*").alias("n"), F.max(F.col("name") == F.col("made")).alias("same")).filter("n > 1 or same")


def surrogates(text: Column, using: Replacer) -> Column:
    """A struct (text, n_entities) for each text."""
    key = using.key

    @F.pandas_udf("text string, n_entities int")
    def run(column: pd.Series) -> pd.DataFrame:
        mine = Replacer(key)
        done = [(None, 0) if t is None else mine.replace(t) for t in column]
        return pd.DataFrame(done, columns=["text", "n_entities"]).astype({"n_entities": np.int32})
    return run(text)


def anonymize(docs: DataFrame, key: str, count_column: str = "n_entities") -> DataFrame:
    """All columns of `docs`, with surrogates in `text`, and their number in `count_column`;
    `n_chars`, where there is one, is that of the new text."""
    new = free_name(docs, "_new")
    done = docs.withColumn(new, surrogates(F.col("text"), Replacer(key)))
    made = F.col(new)
    columns = {"text": made["text"], count_column: made["n_entities"]}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(made["n_entities"] > 0, F.length(made["text"]).cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return done.withColumns(columns).drop(new)
