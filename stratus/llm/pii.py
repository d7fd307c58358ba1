"""Surrogates for personal data and secrets, with DataFrame functions only (operator 4).

An entity's surrogate is a keyed function of its canonical form (lower-cased
address, bare digits with the country code, a first name with its gender, a
surname), so one entity has one surrogate wherever and however it is written.
Digits become digits and letters letters of the same case; addresses move to
reserved domains and networks, card numbers (with a valid check digit only) and
IBANs stay valid, and separators, blanks, country codes, titles and key names
stay as written.

Names are found behind a title; in the same text the bare full name and the
bare surname are then found, too. First names and surnames have surrogates of
their own, so "Mr John Smith", "John Smith" and "Smith" become parts of one
name. A first name's gender is that of any title it has in the text. Names are
replaced in Latin, Cyrillic and Greek script; a name in another script with
capital letters becomes a Latin one, and names without capitals are not found.
A phone number with a country code and one without are two entities, except
with code 1, whose national numbers have ten digits.

The distinct entities of the corpus are checked against each other: of entities
with the same surrogate all but the least, and any whose surrogate is an
entity itself, move to the next counter until none is left. Documents compute
the first surrogate on their own; only the moved entities are joined in.

The key is secret: it is given, or read from the setting ``KEY_SETTING``; without
either one is drawn for the running application, and surrogates of another run
differ. It is part of the query plan, as any literal.

Cases: null and empty texts stay as they are; equal rows are treated alike;
an entity is looked for in whole texts of any length (patterns are anchored at
token starts and possessive, so time follows the length); of surrogates that
clash the least canonical form stays; an empty table gives no rows; extra
columns of any name are kept.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import Rounds, unpacked_row, whole_row, written

KEY_SETTING = "spark.stratus.surrogateKey"
_DRAWN: dict[str, str] = {}
ROUNDS = 64


def surrogate_key(spark: SparkSession) -> str:
    """The configured key, or one drawn for this application."""
    return spark.conf.get(KEY_SETTING, None) or _DRAWN.setdefault(
        spark.sparkContext.applicationId, secrets.token_hex(32))


# Titles by gender, reserved top-level domains, names, syllables and endings by
# script, country codes of two digits (1 and 7 have one, all others three).
TITLES = {"m": ("Mr", "Herr", "Sr", "Señor", "Monsieur", "Господин", "г-н", "Κύριος", "κ"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Sra", "Señora", "Madame", "Госпожа", "г-жа", "Κυρία", "κα"),
          "n": ("Dr", "Prof")}
FIRST_NAMES = {
    "latin": {"m": ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo"),
              "f": ("Anna", "Berta", "Clara", "Diana", "Emma", "Frida", "Helen", "Irene", "Julia", "Lena"),
              "n": ("Alex", "Robin", "Kim", "Sam", "Chris", "Jules", "Andrea", "Noel", "Sascha", "Toni")},
    "cyrillic": {"m": ("Адам", "Борис", "Виктор", "Глеб", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Олег"),
                 "f": ("Анна", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Ирина", "Лариса", "Мария", "Ольга"),
                 "n": ("Саша", "Женя", "Валя", "Слава", "Шура", "Паша", "Тоня", "Вася", "Миша", "Люба")},
    "greek": {"m": ("Άρης", "Γιώργος", "Δήμος", "Κώστας", "Λευτέρης", "Μάριος", "Νίκος", "Πέτρος", "Σπύρος", "Τάσος"),
              "f": ("Άννα", "Βάσω", "Δήμητρα", "Ελένη", "Ζωή", "Ηρώ", "Κατερίνα", "Λένα", "Μαρία", "Νίκη"),
              "n": ("Αλέξη", "Χρύση", "Φώτη", "Τόνια", "Ρένα", "Σάκη", "Λίτσα", "Ντάνι", "Μίνα", "Ζέτα")}}
SYLLABLES = {"latin": ("ba", "do", "fe", "gi", "ka", "lo", "mi", "na", "pe", "ri", "sa", "to", "ve", "wi", "zu", "he"),
             "cyrillic": ("ба", "до", "фе", "ги", "ка", "ло", "ми", "на", "пе", "ри", "са", "то", "ве", "зи", "зу", "хе"),
             "greek": ("βα", "δο", "φε", "γι", "κα", "λο", "μι", "να", "πε", "ρι", "σα", "το", "βε", "ζι", "ζο", "χε")}
ENDINGS = {"latin": {"m": "n", "f": "a", "n": "e"}, "cyrillic": {"m": "н", "f": "я", "n": "е"},
           "greek": {"m": "ς", "f": "α", "n": "ι"}}
TWO_DIGIT_CODES = ("20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48",
                   "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81",
                   "82", "84", "86", "90", "91", "92", "93", "94", "95", "98")
RESERVED = ("com", "net", "org")

_LETTER = r"[\p{L}]"
_TITLES = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
# A word of a name: apostrophes and hyphens inside, but not the ending 's.
_WORD = r"\p{Lu}\p{L}*+(?:['’-](?!s(?!\p{L}))\p{L}++)*+"
_NAME = rf"{_WORD}(?:\h{_WORD}){{0,2}}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_KEYS = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)"
_ASSIGN = rf"(?i:{_KEYS})[\"']?\h{{0,3}}[:=]\h{{0,3}}[\"']?"
_SECRET = r"[A-Za-z0-9+/_~.-]{6,}+=*+"
_HEX = "[0-9A-Fa-f]{1,4}"

# Check digits are beyond a regular expression, so cards are sought first (``_marked``) and stand
# between marks; a mark in the text itself is followed by the second sign.
_MARK, _OWN_MARK = "\ufdd0", "\ufdd0\ufdd1"

# Alternatives in order of preference at one position. All but addresses start where no ASCII
# letter or digit stands before (checked once for all), so a token is scanned once.
PATTERNS = {
    "email": r"(?<![._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ipv6": (rf"(?<![:.])(?=[0-9A-Fa-f]{{0,4}}:[0-9A-Fa-f]{{0,4}}:)(?=[A-Fa-f:]*[0-9])(?:(?:{_HEX}:){{7}}{_HEX}"
             rf"|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|::(?:{_HEX}:){{0,6}}{_HEX}|(?:{_HEX}:){{1,7}}:)(?![0-9A-Za-z:])"),
    "secret": (rf"{_ASSIGN}{_SECRET}|(?:AKIA|ASIA)[0-9A-Z]{{16}}(?![0-9A-Za-z])"
               r"|(?:ghp_|gho_|sk-|pk-|xox[abp]-)[A-Za-z0-9_-]{16,}+"),
    "iban": r"[A-Z]{2}[0-9]{2}(?:\h?[A-Z0-9]{4}){3,7}(?:\h?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9]\.)(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9])(?!\.[0-9])",
    "card": rf"{_MARK}[3-6][0-9 -]*+{_MARK}",
    "ssn": r"(?<!-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])",
    "phone": (r"(?<!\+)(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])"
              r"[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9])|(?<!\+)\+[0-9]{8,15}(?![0-9])"),
    "name": rf"(?<!\p{{L}})(?:{_TITLES})\.?\h{_NAME}",
}
PATTERN = (r"(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values())
           + rf")|(?=[0-9])(?<![0-9])(?:{PATTERNS['ip']})")
# Ways of writing a card number, in order of preference at one position: unbroken, 4-4-4-4, 4-6-5
# and 4-6-4, other lengths in fours; last any grouping, the longest one and, at the beginning of
# a row of numbers, shorter ones.
CARDS = (r"[3-6][0-9]{12,18}", r"[3-6][0-9]{3}(?:[ -][0-9]{4}){3}", r"[3-6][0-9]{3}[ -][0-9]{6}[ -][0-9]{4,5}",
         r"[3-6][0-9]{3}(?:[ -][0-9]{4}){2,3}[ -][0-9]{1,3}(?![ -]?[0-9])")
ODD_CARDS = (r"[3-6](?:[ -]?[0-9]){12,18}",
             *(rf"(?<![0-9][ -])[3-6](?:[ -]?[0-9]){{{n - 1}}}" for n in (16, 15, 14, 13)))
_LONG = r"[3-6](?:[ -]?[0-9]){12}"
_ROW = r"[0-9]++(?:[ -][0-9]++)*+"
_ROWS = (r"(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{PATTERNS[k]})" for k in ("email", "ipv6", "secret", "iban", "ip"))
         + rf"|(?=[(+])(?:{PATTERNS['phone']})|{_ROW})")
# Every match has one of these: a cheap scan that spares most texts the full patterns.
_SIGN = rf"[0-9@:=_-]|(?=[{''.join(sorted({t[0] for ts in TITLES.values() for t in ts}))}])(?:{_TITLES})\.?\h\p{{Lu}}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _marked_row(row: Column, shapes: tuple[str, ...]) -> Column:
    """A row of numbers with marks around those of its ``shapes`` that are cards by their check digit."""
    found = F.concat(*[F.regexp_extract_all(row, F.lit(f"(?<![0-9])(?=({s})(?![0-9]))"), F.lit(1)) for s in shapes])
    cards = F.array_distinct(F.filter(found, lambda c: _luhn(_digits(c)) == 0))
    one = F.concat(F.lit(f"(?<![0-9{_MARK}])(?:"), F.array_join(cards, "|"), F.lit(")(?![0-9])"))
    return F.when(F.size(cards) > 0, F.regexp_replace(row, one, F.lit(f"{_MARK}$0{_MARK}"))).otherwise(row)


def _marked(text: Column) -> Column:
    """``text`` with marks around its card numbers.

    A number that its check digit rules out is left to the other patterns, as
    are the numbers beside a card. A card written in odd groups is looked for
    only in rows of numbers without a phone or ssn.
    """
    other = rf"(?<![0-9])(?:{PATTERNS['ssn']}|{PATTERNS['phone']})"

    def one(found: Column) -> Column:
        def rest(row: Column) -> Column:
            return F.when(row.rlike(_LONG) & ~row.rlike(other), _marked_row(row, ODD_CARDS)).otherwise(row)
        return F.when(found.rlike(f"^{_ROW}$") & found.rlike(_LONG), _let(_marked_row(found, CARDS), rest)).otherwise(found)

    def whole(escaped: Column) -> Column:
        between = F.split(escaped, _ROWS, -1)
        found = F.transform(F.regexp_extract_all(escaped, F.lit(_ROWS), F.lit(0)), one)
        pairs = F.zip_with(found, F.slice(between, F.lit(2), F.size(found)), lambda e, after: F.concat(e, after))
        return F.concat(between[0], F.array_join(pairs, ""))

    return F.when(text.rlike(_LONG), _let(F.replace(text, F.lit(_MARK), F.lit(_OWN_MARK)), whole)).otherwise(text)


def titled(text: Column) -> Column:
    """The entities of a ``_marked`` text by the patterns alone, in order of place."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(_SIGN), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(none)


def pattern_with_names(found: Column) -> Column:
    """The pattern of one text: that of all texts, and the bare forms of the names that ``titled`` found in it."""
    rests = F.transform(F.filter(found, lambda e: kind(e) == "name"), lambda e: F.substring(
        e, F.length(_prefix(e, F.lit("name"))) + 1, F.length(e)))
    forms = F.array_distinct(F.flatten(F.transform(rests, lambda r: F.array(r, _surname_of(r)))))
    longest_first = F.array_sort(forms, lambda a, b: F.length(b) - F.length(a))
    bare = F.array_join(F.transform(longest_first, lambda f: F.concat(F.lit("\\Q"), f, F.lit("\\E"))), "|")
    return F.when(F.size(forms) > 0, F.concat(
        F.lit(PATTERN + r"|(?<![\p{L}\p{N}])(?:"), bare, F.lit(r")(?![\p{L}\p{N}]|['’-](?!s(?!\p{L}))\p{L})"))).otherwise(PATTERN)


def entities(text: Column, found: Column, pattern: Column) -> Column:
    """All entities of a ``_marked`` text: ``found`` by the patterns, and bare names if the text's pattern has any."""
    return F.when(pattern != PATTERN, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(found)


def kind(entity: Column) -> Column:
    """Name of the pattern that an entity matched."""
    out = F.lit("name")
    for name, p in reversed([x for x in PATTERNS.items() if x[0] != "name"]):
        out = F.when(entity.rlike(f"^(?:{p})$"), name).otherwise(out)
    return out


def _prefix(entity: Column, what: Column) -> Column:
    """The part that stays as written: the key of an assignment, the title of a name."""
    return (F.when(what == "secret", F.regexp_extract(entity, f"^({_ASSIGN})", 1))
             .when(what == "name", F.regexp_extract(entity, rf"^((?:{_TITLES})\.?\h)", 1))
             .otherwise(""))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _rest(entity: Column, what: Column) -> Column:
    return F.substring(entity, F.length(_prefix(entity, what)) + 1, F.length(entity))


def _words(name: Column) -> Column:
    return F.split(F.regexp_replace(name, r"\h+", " "), " ")


def _surname_of(name: Column) -> Column:
    return F.element_at(_words(name), -1)


def _first_of(name: Column) -> Column:
    """All words of a name but the last, empty if there is one word only."""
    return _let(_words(name), lambda w: F.array_join(F.slice(w, F.lit(1), F.size(w) - 1), " "))


def _gender(entity: Column) -> Column:
    title, out = F.regexp_extract(entity, rf"^({_TITLES})", 1), F.lit("n")
    for g in "mf":
        out = F.when(title.isin(*TITLES[g]), g).otherwise(out)
    return out


def genders(found: Column) -> Column:
    """(first, gender) of the first names that have a gendered title somewhere in the text."""
    names = F.filter(found, lambda e: (kind(e) == "name") & (_gender(e) != "n"))
    return F.transform(names, lambda e: F.struct(
        _first_of(_rest(e, F.lit("name"))).alias("first"), _gender(e).alias("gender")))


def _national(digits: Column) -> Column:
    """Digits of a country code at the beginning of ``digits``: how many."""
    return (F.when(F.substring(digits, 1, 1).isin("1", "7"), 1)
             .when(F.substring(digits, 1, 2).isin(*TWO_DIGIT_CODES), 2).otherwise(3))


def _phone_of(entity: Column) -> Column:
    """Country code with its plus (none for code 1 and where it is not written), a bar, and the national digits."""
    def with_code(digits: Column) -> Column:
        n = _national(digits)
        code, rest = F.substr(digits, F.lit(1), n), F.substr(digits, n + 1, F.length(digits))
        return F.when(code == "1", F.concat(F.lit("|"), rest)).otherwise(F.concat(F.lit("+"), code, F.lit("|"), rest))
    return _let(_digits(entity), lambda d: F.when(entity.startswith("+"), with_code(d)).otherwise(F.concat(F.lit("|"), d)))


def canonical(entity: Column, what: Column) -> Column:
    """What an entity other than a name is whichever way it is written."""
    return (F.when(what.isin("email", "ipv6"), F.lower(entity))
             .when(what.isin("card", "ssn"), _digits(entity))
             .when(what == "phone", _phone_of(entity))
             .when(what == "iban", F.regexp_replace(entity, r"\h", ""))
             .otherwise(_rest(entity, what)))


def _first_canon(entity: Column, known: Column) -> Column:
    """A first name with its gender: by ``known`` (``genders`` of the text), else none; empty without a first name."""
    def of(first: Column) -> Column:
        own = F.filter(known, lambda k: k["first"] == first)
        gender = F.when(F.size(own) > 0, F.get(own, F.lit(0))["gender"]).otherwise("n")
        return F.when(first == "", "").otherwise(F.concat(gender, F.lit("|"), first))
    return _let(_first_of(_rest(entity, F.lit("name"))), of)


def parts(entity: Column, known: Column) -> Column:
    """The entities, as (kind, canon), that one found string stands for: a name's first name and surname are two."""
    def pair(what: Column, canon: Column) -> Column:
        return F.struct(what.alias("kind"), canon.alias("canon"))

    def of(what: Column) -> Column:
        last = pair(F.lit("last"), _surname_of(_rest(entity, what)))
        both = F.filter(F.array(pair(F.lit("first"), _first_canon(entity, known)), last), lambda x: x["canon"] != "")
        return F.when(what == "name", both).otherwise(F.array(pair(what, canonical(entity, what))))
    return _let(kind(entity), of)


def _byte(stream: Column, i: Column) -> Column:
    """Byte i (from 0, repeating after 64) of a 128-digit hexadecimal stream."""
    return F.conv(F.substr(stream, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(values: tuple[str, ...], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (at % len(values) + 1).cast("int"))


def _letters(alphabet: str, at: Column) -> Column:
    return F.substr(F.lit(alphabet), at % len(alphabet) + 1, F.lit(1))


def _alike(s: Column, stream: Column, hexadecimal: Column | None = None) -> Column:
    """``s`` with each digit and letter replaced by the stream's, class and case kept."""
    lower = "abcdefghijklmnopqrstuvwxyz"

    def one(ch: Column, i: Column) -> Column:
        at = _byte(stream, i)
        small = _letters(lower, at) if hexadecimal is None else F.when(
            hexadecimal, _letters(lower[:6], at)).otherwise(_letters(lower, at))
        return (F.when(ch.between("0", "9"), (at % 10).cast("string"))
                 .when(ch.between("a", "z"), small)
                 .when(ch.between("A", "Z"), F.upper(small)).otherwise(ch))

    return F.array_join(F.transform(F.split(s, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10."""
    def add(total: Column, x: Column) -> Column:
        return total + x
    d = F.transform(F.split(F.reverse(digits), ""), lambda ch, i: _let(
        ch.cast("int") * (1 + i % 2), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.aggregate(d, F.lit(0), add) % 10


def _card(digits: Column, stream: Column) -> Column:
    """Random digits after the first, the last one set so that the Luhn sum is the old one's."""
    def fixed(body: Column) -> Column:
        want = _luhn(digits)
        missing = (want - _luhn(F.concat(body, F.lit("0"))) + 10) % 10
        return F.concat(body, missing.cast("string"))
    n = F.length(digits)
    body = F.concat(F.substring(digits, 1, 1), _alike(F.substring(digits, F.lit(2), n - 2), stream))
    return _let(body, fixed)


def _surname(syllables: tuple[str, ...], stream: Column, counter: Column) -> Column:
    parts = F.transform(F.sequence(F.lit(1), F.lit(3) + counter),
                        lambda i: _pick(syllables, _byte(stream, i)))
    return F.initcap(F.array_join(parts, ""))


def _by_script(name: Column, made: Callable[[str], Column]) -> Column:
    """``made`` for the script of ``name``; Latin for any other."""
    return (F.when(name.rlike(r"\p{IsCyrillic}"), made("cyrillic"))
             .when(name.rlike(r"\p{IsGreek}"), made("greek")).otherwise(made("latin")))


def _first_name(canon: Column, stream: Column, counter: Column) -> Column:
    """A common first name of the gender; after a clash one of 2 + counter syllables with its ending."""
    def made(script: str) -> Column:
        out = None
        for g in "mfn":
            more = F.initcap(F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(1) + counter), lambda i: _pick(
                SYLLABLES[script], _byte(stream, i))), ""), F.lit(ENDINGS[script][g])))
            one = F.when(counter == 0, _pick(FIRST_NAMES[script][g], _byte(stream, F.lit(0)))).otherwise(more)
            out = one if out is None else F.when(F.substring(canon, 1, 1) == g, one).otherwise(out)
        return out
    return F.concat(F.substring(canon, 1, 2), _by_script(canon, made))


def _iban(canon: Column, stream: Column) -> Column:
    """The country with other account characters of the same kind, and the check digits that fit them."""
    def checked(account: Column) -> Column:
        country = F.substring(canon, 1, 2)

        def add(total: Column, ch: Column) -> Column:
            digit = ch.between("0", "9")
            value = F.when(digit, F.ascii(ch) - 48).otherwise(F.ascii(ch) - 55)
            return (total * F.when(digit, 10).otherwise(100) + value) % 97
        left = F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), add)
        return F.concat(country, F.lpad((98 - left).cast("string"), 2, "0"), account)
    return _let(_alike(F.substring(canon, 5, 40), stream), checked)


def _phone(canon: Column, stream: Column) -> Column:
    """Other national digits; a leading 0 stays, any other first digit is 2 to 9."""
    national = F.substring_index(canon, "|", -1)
    first = F.when(national.startswith("0"), "0").otherwise((_byte(stream, F.lit(63)) % 8 + 2).cast("string"))
    return F.concat(F.substring_index(canon, "|", 1), F.lit("|"), first, _alike(F.substring(national, 2, 40), stream))


def surrogate(what: Column, canon: Column, counter: Column, key: str) -> Column:
    """Canonical surrogate of a canonical entity."""
    stream = F.sha2(F.concat_ws("\x1f", F.lit(key), what, canon, counter.cast("string")), 512)

    def made(h: Column) -> Column:
        local = F.substring_index(canon, "@", 1)
        tld = F.substring_index(canon, ".", -1)
        email = F.concat(_alike(local, h), F.lit("@"), _letters("abcdefghijklmnopqrstuvwxyz", _byte(h, F.lit(61))),
                         _letters("abcdefghijklmnopqrstuvwxyz", _byte(h, F.lit(62))),
                         (_byte(h, F.lit(63)) % 10).cast("string"), F.lit(".example."),
                         F.when(tld.isin(*RESERVED), tld).otherwise("org"))
        ip = F.concat_ws(".", (240 + _byte(h, F.lit(0)) % 15).cast("string"),
                         *[_byte(h, F.lit(i)).cast("string") for i in (1, 2, 3)])
        secret = F.concat(F.regexp_extract(canon, "^(AKIA|ASIA|gh[po]_|[sp]k-|xox[abp]-|)", 1), _alike(
            F.regexp_replace(canon, "^(?:AKIA|ASIA|gh[po]_|[sp]k-|xox[abp]-)", ""), h,
            canon.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")))
        groups = [F.substring(h, 1 + 4 * i, 4) for i in range(6)]
        return (F.when(what == "email", email).when(what == "ip", ip)
                 .when(what == "ipv6", F.concat_ws(":", F.lit("2001"), F.lit("db8"), *groups))
                 .when(what == "card", _card(canon, h)).when(what == "first", _first_name(canon, h, counter))
                 .when(what == "last", _by_script(canon, lambda script: _surname(SYLLABLES[script], h, counter)))
                 .when(what == "ssn", F.concat(F.lit("9"), _alike(F.substring(canon, 2, 8), h)))
                 .when(what == "iban", _iban(canon, h)).when(what == "phone", _phone(canon, h))
                 .when(what == "secret", secret).otherwise(_alike(canon, h)))

    return _let(stream, made)


def _laid_out(entity: Column, what: Column, new: Column) -> Column:
    """A canonical surrogate (not of a name) written the way ``entity`` is."""
    entity = F.replace(entity, F.lit(_MARK), F.lit(""))

    def by_digits(values: Column) -> Column:
        def digit(ch: Column, i: Column) -> Column:
            left = F.length(_digits(F.substr(entity, i + 1, F.length(entity))))
            return F.when(ch.between("0", "9") & (left <= F.length(values)),
                          F.substr(values, F.length(values) - left + 1, F.lit(1))).otherwise(ch)
        return F.array_join(F.transform(F.split(entity, ""), digit), "")

    def spaced(ch: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(entity, F.lit(1), i + 1), r"\h", ""))
        return F.when(ch.rlike(r"\h"), ch).otherwise(F.substr(new, before, F.lit(1)))
    return (F.when(what.isin("card", "ssn"), by_digits(new))
             .when(what == "phone", by_digits(F.substring_index(new, "|", -1)))
             .when(what == "iban", F.array_join(F.transform(F.split(entity, ""), spaced), ""))
             .when(what.isin("email", "ipv6") & (entity == F.upper(entity)) & (entity != F.lower(entity)), F.upper(new))
             .otherwise(F.concat(_prefix(entity, what), new)))


def occurrences(docs: DataFrame, text: str = "text") -> DataFrame:
    """(content, kind, canon): the entities of each distinct content (the text's hash)."""
    found = with_entities(docs.select(F.xxhash64(text).alias("content"), F.col(text).alias("text")))
    # an outer explode: for a plain one Spark infers a filter that finds all entities a second time
    every = found.select("content", F.explode_outer(F.flatten(F.transform(
        "found", lambda e: parts(e, F.col("known"))))).alias("e"))
    return every.where(F.col("e").isNotNull()).select("content", "e.kind", "e.canon").distinct()


def with_entities(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``text``) and marked, found (all entities), pattern, known (first names' genders)."""
    rows = rows.withColumn("marked", _marked(F.col("text"))).withColumn("titled", titled(F.col("marked")))
    rows = rows.withColumn("pattern", pattern_with_names(F.col("titled"))).withColumn("known", genders(F.col("titled")))
    return rows.withColumn("found", entities(F.col("marked"), F.col("titled"), F.col("pattern"))).drop("titled")


def settle(entities_: DataFrame, key: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(kind, canon, counter, surrogate) without two surrogates alike or equal to an entity."""
    key = key or surrogate_key(entities_.sparkSession)
    start = entities_.withColumn("counter", F.lit(0))
    kept, steps = Rounds("surrogates"), Rounds("clashes")
    now = kept.write(start.withColumn("surrogate", surrogate(
        F.col("kind"), F.col("canon"), F.col("counter"), key)))
    for _ in range(rounds):
        keeper = now.groupBy("kind", "surrogate").agg(F.min_by("canon", F.struct("counter", "canon")).alias("keeper"),
                                                      F.count(F.lit(1)).alias("n"))
        shared = now.join(keeper.where("n > 1"), ["kind", "surrogate"]).where("canon <> keeper").select("kind", "canon")
        taken = now.join(now.select("kind", F.col("canon").alias("surrogate")), ["kind", "surrogate"],
                         "left_semi").select("kind", "canon")
        moved = steps.write(shared.union(taken).distinct())
        if moved.isEmpty():
            return now
        again = (now.join(moved, ["kind", "canon"], "left_semi").select("kind", "canon", (F.col("counter") + 1).alias("counter"))
                    .withColumn("surrogate", surrogate(F.col("kind"), F.col("canon"), F.col("counter"), key)))
        now = kept.write(now.join(moved, ["kind", "canon"], "left_anti").union(again.select(*now.columns)))
    raise ValueError(f"surrogates still clash after {rounds} rounds: too small a set of values for them")


def _replaced(text: Column, found: Column, pattern: Column, known: Column, counters: Column | None, key: str) -> Column:
    """``_marked`` text with the entities ``found`` replaced; ``counters`` maps kind and canon to a counter above 0."""
    def one(what: Column, canon: Column) -> Column:
        n = F.lit(0)
        if counters is not None:
            n = F.coalesce(F.try_element_at(counters, F.concat_ws("\x1f", what, canon)), F.lit(0))
        return surrogate(what, canon, n, key)

    def name(e: Column) -> Column:
        first = _let(_first_canon(e, known), lambda c: F.when(c == "", "").otherwise(F.concat(
            F.substring(one(F.lit("first"), c), 3, 1000), F.lit(" "))))
        last = _let(_surname_of(_rest(e, F.lit("name"))), lambda c: one(F.lit("last"), c))
        return F.concat(_prefix(e, F.lit("name")), first, last)

    def new(e: Column) -> Column:
        def with_kind(what: Column) -> Column:
            other = _let(canonical(e, what), lambda c: _let(one(what, c), lambda s: _laid_out(e, what, s)))
            return F.when(what == "name", name(e)).otherwise(other)
        return _let(kind(e), with_kind)
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(F.transform(found, new), F.slice(between, F.lit(2), F.size(found)),
                       lambda e, after: F.concat(e, after))
    return F.concat(between[0], F.array_join(pairs, ""))


def pseudonymised(docs: DataFrame, key: str | None = None, text: str = "text", kinds: str | None = None) -> DataFrame:
    """``docs`` with ``text`` rewritten (and n_chars, where there is one, counted again).

    The column ``kinds``, if named, gets the kinds of the entities replaced.
    """
    key = key or surrogate_key(docs.sparkSession)
    met = written(occurrences(docs, text), "occurrences")
    moved = settle(met.select("kind", "canon").distinct(), key).where("counter > 0")
    rows, counters = with_entities(docs.select(whole_row(docs).alias("row"), F.col(text).alias("text"))), None
    if not moved.isEmpty():
        by_text = (met.join(moved, ["kind", "canon"]).groupBy("content")
                      .agg(F.map_from_entries(F.collect_list(F.struct(
                          F.concat_ws("\x1f", "kind", "canon"), F.col("counter")))).alias("moved")))
        rows = rows.withColumn("content", F.xxhash64("text")).join(written(by_text, "moved"), "content", "left")
        counters = F.coalesce("moved", F.create_map().cast("map<string,int>"))
    new = _replaced(F.col("marked"), F.col("found"), F.col("pattern"), F.col("known"), counters, key)
    new = F.when(F.col("text").rlike(_LONG), F.replace(new, F.lit(_OWN_MARK), F.lit(_MARK))).otherwise(new)
    rows = rows.withColumn("new", F.when(F.size("found") > 0, new).otherwise(F.col("text")))
    changed = {text: F.col("new")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("new").cast(docs.schema["n_chars"].dataType)
    out = unpacked_row(docs, "row", **changed)
    if kinds:
        out.append(F.transform("found", kind).alias(kinds))
    return rows.select(*out)


def surrogate_texts(docs: DataFrame, key: str | None = None) -> DataFrame:
    """doc_id, text (with surrogates), n_entities and their kinds for every row."""
    out = pseudonymised(docs.select("doc_id", "text"), key, kinds="kinds")
    return out.select("doc_id", "text", F.size("kinds").alias("n_entities"), "kinds")
