"""PII: format-preserving Feistel pseudonyms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import text_of

ROUNDS = 8
#: dates from 1900-01-01 on that are permuted among themselves: a square number of days
FIRST_DATE, DATE_SIDE = "1900-01-01", 270

# Formats that are looked for, in the order in which they are tried at a place. Fixed values.
_L = "\\u00C0-\\u024F"
EMAIL = (
    rf"(?<![A-Za-z0-9{_L}._%+-])[A-Za-z0-9{_L}._%+-]{{1,64}}+@[A-Za-z0-9{_L}-]{{1,63}}+"
    rf"(?:\.[A-Za-z0-9{_L}-]{{1,63}}+){{0,8}}(?<=\.[A-Za-z{_L}]{{2,24}})"
)
KEY_BLOCK = (
    r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s:,]{16,}+"
    r"-----END (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----"
)
SECRET = (
    r"(?i:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
    r"(?=[A-Za-z+/_.!@#$%^&*~-]*+\d)[A-Za-z0-9+/_.!@#$%^&*~-]{12,}(?<![.!])"
)
BEARER = r"\b[Bb]earer\s{1,3}(?=[A-Za-z+/_.~-]*+\d)[A-Za-z0-9+/_.~-]{16,}(?<!\.)"
TOKEN = (
    r"(?<![A-Za-z0-9_-])(?:gh[oprsu]_|github_pat_|glpat-|sk-|sk_live_|rk_live_|xox[abeoprs]-|npm_|pypi-)"
    r"(?=[A-Za-z_-]*+\d)[A-Za-z0-9_-]{16,}"
)
ACCESS_KEY = r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b"
IPV4 = r"(?<![\w.])(?<![Vv]ersion )(?<!release )(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)"
IPV6 = (
    r"(?<![\w:.])(?=[0-9A-Fa-f:]{2,39}(?![\w:]))(?=[:A-Fa-f]*+\d)"
    r"(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])"
)
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
ISO_DATE = r"(?<![\w-])\d{4}-\d{2}-\d{2}(?!\w|-\d)"
LONG_DATE = r"(?<![\w./])\d{2}([./])\d{2}\1\d{4}(?!\w|[./]\d)"
PHONE = r"(?<!\w)\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\w)"
LOCAL_PHONE = (
    r"(?<![\w(])\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{4}(?!\w)"
    r"|(?<![\w+(.-])(?<!\d[ ])\d{3}(?:-\d{3}-|\.\d{3}\.|[ ]\d{3}[ ])\d{4}(?!\w|[ .-]\d)"
)
NATIONAL_PHONE = r"(?<![\w+(.-])(?<!\d[ ])0\d{1,4}(?:[ ]\d{3,4}[ ]|-\d{3,4}-)\d{3,4}(?!\w|[ .-]\d)"
SOCIAL = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?!\w|-\d)"
CARD = r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?!\w|[.-]\d)"

KINDS = {
    "key_block": KEY_BLOCK,
    "email": EMAIL,
    "secret": SECRET,
    "bearer": BEARER,
    "token": TOKEN,
    "access_key": ACCESS_KEY,
    "iban": IBAN,
    "ipv4": IPV4,
    "ipv6": IPV6,
    "iso_date": ISO_DATE,
    "date": LONG_DATE,
    "phone": PHONE,
    "national_phone": NATIONAL_PHONE,
    "local_phone": LOCAL_PHONE,
    "social": SOCIAL,
    "card": CARD,
}
#: what stands between the digits of a number
SEPARATORS = " .-()+:"
#: country codes: of one digit, of two, else of three
COUNTRY = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
ANY = "|".join(KINDS.values())
#: no format does without one of these, so most texts are passed by
HINT = "[0-9@]"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEX = "0123456789abcdef"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _noise(key: str, tweak: Column, half: Column, n: Column) -> Column:
    """``n`` numbers below 65,536 from a keyed digest of the other half."""
    message = F.concat_ws("|", F.lit(key), tweak, F.array_join(F.transform(half, lambda x: x.cast("string")), ","))

    def block(m: Column, b: Column) -> Column:
        return _let(
            F.sha2(F.concat(m, F.lit("#"), b.cast("string")), 512),
            lambda digits: F.transform(
                F.sequence(F.lit(0), F.least(F.lit(31), n - b * 32 - 1)),
                lambda i: F.conv(F.substring(digits, i * 4 + 1, F.lit(4)), 16, 10).cast("int"),
            ),
        )

    blocks = F.sequence(F.lit(0), F.floor((n - 1) / 32).cast("int"))
    return _let(message, lambda m: F.flatten(F.transform(blocks, lambda b: block(m, b))))


def feistel(symbols: Column, sizes: Column, key: str, tweak: Column) -> Column:
    """Permute sequences of symbols that are each below their own size, keyed by ``key`` and ``tweak``.

    The halves of a sequence change in turn: each symbol of one is moved on, modulo its size, by a keyed digest of
    the other. So the result has the same format, and different sequences have different results.
    """

    def moved(own: Column, sizes: Column, other: Column, turn: Column) -> Column:
        noise = _noise(key, F.concat(tweak, F.lit(":"), turn.cast("string")), other, F.size(own))
        shifted = lambda more: F.zip_with(F.zip_with(own, more, lambda x, y: x + y), sizes, lambda x, n: x % n)
        return F.when(F.size(own) == 0, own).otherwise(_let(noise, shifted))

    def run(split: Column) -> Column:
        done = F.aggregate(
            F.sequence(F.lit(1), F.lit(ROUNDS)),
            F.struct(split["l"].alias("l"), split["r"].alias("r")),
            lambda s, turn: F.when(
                turn % 2 == 1, F.struct(moved(s["l"], split["ls"], s["r"], turn).alias("l"), s["r"].alias("r"))
            ).otherwise(F.struct(s["l"].alias("l"), moved(s["r"], split["rs"], s["l"], turn).alias("r"))),
        )
        return _let(done, lambda d: F.concat(d["l"], d["r"]))

    half = F.ceil(F.size(symbols) / 2).cast("int")
    rest = F.size(symbols) - half
    return _let(
        F.struct(
            F.slice(symbols, F.lit(1), half).alias("l"), F.slice(symbols, half + 1, rest).alias("r"),
            F.slice(sizes, F.lit(1), half).alias("ls"), F.slice(sizes, half + 1, rest).alias("rs"),
        ),
        run,
    )


def permuted(text: Column, key: str, kind: str) -> Column:
    """Characters permuted within digits, lower-case or upper-case letters, or within hexadecimal digits if all are.

    Other characters stay as they are.
    """

    def alphabets(chars: Column, is_hex: Column) -> Column:
        return F.transform(
            chars,
            lambda c: F.when(is_hex, F.lit(_HEX))
            .when(c.between("0", "9"), F.lit(_DIGITS))
            .when(c.between("a", "z"), F.lit(_LOWER))
            .when(c.between("A", "Z"), F.lit(_UPPER))
            .otherwise(c),
        )

    def run(x: Column) -> Column:
        symbols = F.zip_with(x["chars"], x["alphabets"], lambda c, a: (F.position(c, a) - 1).cast("int"))
        sizes = F.transform(x["alphabets"], lambda a: F.length(a))
        done = _let(
            F.struct(symbols.alias("s"), sizes.alias("n")), lambda y: feistel(y["s"], y["n"], key, F.lit(kind))
        )
        return F.array_join(F.zip_with(done, x["alphabets"], lambda s, a: F.substring(a, s + 1, F.lit(1))), "")

    is_hex = text.rlike("^[0-9a-f]+$") & ~text.rlike("^[0-9]+$")
    once = F.struct(F.filter(F.split(text, ""), lambda c: c != "").alias("chars"), is_hex.alias("is_hex"))
    both = _let(
        once, lambda x: F.struct(x["chars"].alias("chars"), alphabets(x["chars"], x["is_hex"]).alias("alphabets"))
    )
    return F.when(F.length(text) == 0, text).otherwise(_let(both, run))


def _address(text: Column, key: str) -> Column:
    octets = F.transform(F.split(text, r"\."), lambda o: o.cast("int"))
    sizes = F.array(*[F.lit(256)] * 4)
    new = _let(octets, lambda o: F.when(F.forall(o, lambda x: x < 256), feistel(o, sizes, key, F.lit("ipv4"))))
    return F.coalesce(F.array_join(F.transform(new, lambda x: x.cast("string")), "."), text)


def _address6(text: Column, key: str) -> Column:
    """Its hexadecimal digits in place, in the case that they are in."""
    new = _spaced(text, lambda digits: permuted(F.lower(digits), key, "ipv6"))
    return F.when((text == F.upper(text)) & (text != F.lower(text)), F.upper(new)).otherwise(F.lower(new))


def _remainder(account: Column) -> Column:
    """An account number's remainder by 97, letters counting from 10 on."""

    def step(done: Column, c: Column) -> Column:
        value = F.position(c, F.lit(_DIGITS + _UPPER)) - 1
        return F.when(value < 10, (done * 10 + value) % 97).otherwise((done * 100 + value) % 97).cast("int")

    return F.aggregate(F.filter(F.split(account, ""), lambda c: c != ""), F.lit(0), step)


def _account(bare: Column, key: str) -> Column:
    """An account number with right check digits, with new ones; any other stays."""
    country, inner = F.substring(bare, 1, 2), F.substring(bare, F.lit(5), F.length(bare))
    valid = _remainder(F.concat(inner, F.substring(bare, 1, 4))) == 1

    def checked(new: Column) -> Column:
        digits = 98 - _remainder(F.concat(new, country, F.lit("00")))
        return F.concat(country, F.lpad(digits.cast("string"), 2, "0"), new)

    return F.when(valid, _let(permuted(inner, key, "iban"), checked)).otherwise(bare)


def _date(text: Column, key: str, formats: list[str]) -> Column:
    """A date of the first format that it is valid in, moved among the days of about two centuries."""
    out = text
    for form in reversed(formats):
        days = F.datediff(F.try_to_timestamp(text, F.lit(form)).cast("date"), F.lit(FIRST_DATE).cast("date"))
        fits = days.between(0, DATE_SIDE * DATE_SIDE - 1)
        pair = F.array(F.floor(days / DATE_SIDE).cast("int"), (days % DATE_SIDE).cast("int"))
        sizes = F.array(F.lit(DATE_SIDE), F.lit(DATE_SIDE))
        new = _let(
            _let(pair, lambda p: feistel(p, sizes, key, F.lit("date"))),
            lambda p: F.date_format(
                F.date_add(F.lit(FIRST_DATE).cast("date"), F.get(p, F.lit(0)) * DATE_SIDE + F.get(p, F.lit(1))),
                form,  # noqa: B023
            ),
        )
        out = F.when(fits, new).otherwise(out)
    return out


def _card(digits: Column, key: str) -> Column:
    """A number that passes the Luhn check, with a new check digit; any other stays."""
    front = F.substring(digits, F.lit(1), F.length(digits) - 1)
    check = lambda x: F.call_function("luhn_check", x)

    def checked(new: Column) -> Column:
        tries = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(new, d.cast("string")))
        return F.get(F.filter(tries, check), F.lit(0))

    return F.when(check(digits), _let(permuted(front, key, "card"), checked)).otherwise(digits)


def _spaced(text: Column, change: Callable[[Column], Column]) -> Column:
    """A number whose bare digits are changed; its separators stay where they are."""
    bare = lambda x: F.translate(x, SEPARATORS, "")
    return _let(
        _let(bare(text), change),
        lambda new: F.array_join(
            F.transform(
                F.sequence(F.lit(1), F.length(text)),
                lambda i: _let(
                    F.substring(text, i, F.lit(1)),
                    lambda c: F.when(F.contains(F.lit(SEPARATORS), c), c).otherwise(
                        F.substring(new, F.length(bare(F.substring(text, F.lit(1), i))), F.lit(1))
                    ),
                ),
            ),
            "",
        ),
    )


def _behind(text: Column, key: str, kind: str, prefix: str) -> Column:
    """What follows the prefix is permuted."""
    head = F.regexp_extract(text, prefix, 0)
    return _let(head, lambda h: F.concat(h, permuted(F.substring(text, F.length(h) + 1, F.length(text)), key, kind)))


def kind_of(match: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS.items()):
        out = F.when(match.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def pseudonym(match: Column, kind: Column, key: str) -> Column:
    """What stands for a match: of the same format, and the same wherever the match occurs."""
    local = F.substring_index(match, "@", 1)
    return (
        F.when(
            kind == "email",
            F.concat(permuted(local, key, "email"), F.substring(match, F.length(local) + 1, F.length(match))),
        )
        .when(kind == "secret", _behind(match, key, "secret", r"^[^=:]*[=:]\s*[\"']?"))
        .when(kind == "bearer", _behind(match, key, "secret", r"^[Bb]earer\s+"))
        .when(kind == "token", _behind(match, key, "secret", "^(?:github_pat_|[rs]k_live_|[a-z]+[_-])"))
        .when(
            kind == "key_block",
            F.concat(
                F.regexp_extract(match, "^-----[A-Z0-9 ]+-----", 0),
                permuted(F.regexp_extract(match, "^-----[A-Z0-9 ]+-----([^-]*)", 1), key, "secret"),
                F.regexp_extract(match, "-----[A-Z0-9 ]+-----$", 0),
            ),
        )
        .when(kind == "iban", _spaced(match, lambda bare: _account(bare, key)))
        .when(kind == "ipv6", _address6(match, key))
        .when(kind == "access_key", _behind(match, key, "access_key", "^[A-Z]{4}"))
        .when(kind == "ipv4", _address(match, key))
        .when(kind == "iso_date", _date(match, key, ["yyyy-MM-dd"]))
        .when((kind == "date") & match.contains("."), _date(match, key, ["dd.MM.yyyy", "MM.dd.yyyy"]))
        .when(kind == "date", _date(match, key, ["dd/MM/yyyy", "MM/dd/yyyy"]))
        .when(kind == "phone", _spaced(match, lambda digits: _behind(digits, key, "phone", COUNTRY)))
        .when(kind == "national_phone", _spaced(match, lambda digits: _behind(digits, key, "national", "^0")))
        .when(kind == "local_phone", _spaced(match, lambda digits: permuted(digits, key, "phone")))
        .when(kind == "social", _spaced(match, lambda digits: permuted(digits, key, "social")))
        .when(kind == "card", _spaced(match, lambda digits: _card(digits, key)))
        .otherwise(match)
    )


def pseudonymised(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text with its personal numbers, dates, addresses and secrets replaced by keyed pseudonyms.

    Numbers and dates are permuted within their format by a Feistel network, if they are valid: card numbers by
    the Luhn check, whose digit is made anew, IPv4 addresses by their octets, dates by the calendar, bank accounts (IBAN)
    by their check digits, which are made anew. Of mail addresses the local part is permuted (letters beyond ASCII stay), of
    IPv6 addresses the digits, of phone numbers what follows the country code, of keys and passwords the value, of private-key
    blocks the body. Equal values have equal pseudonyms in all texts and different ones have different ones,
    card, phone, account and social numbers in whatever notation: their bare digits are permuted, separators stay. So
    links between documents stay; with another ``key`` they are others. Whoever has the key can invert it.

    A key or password is what follows one of the names in SECRET and = or :, whole, if it has 12 or more letters,
    digits and any of +/_.!@#$%^&*~- and at least one digit; the same behind ``Bearer``, and tokens that begin as TOKEN
    and ACCESS_KEY say. What stays: values without a digit, shorter ones, those behind another name or none, what
    follows any other character in a value, a name parted from its value by four blanks or more, and mail addresses
    with a local part over 64 characters or more than nine domain labels. Phone numbers are those with +,
    those of three, three and four digits with brackets, dashes, dots or spaces, and those of three groups that begin
    with 0; others stay, and so do social numbers without dashes. Four numbers with dots right after ``version`` or
    ``release`` are no address.

    All of this is column expressions, row by row; nothing is shuffled. Most texts have neither digits nor @ and
    are passed by.

    Null and empty texts give empty texts. Null ids and repeated rows pass through. An empty table gives no rows.
    Other columns are not read, whatever their names.

    Columns: doc_id, text, n_replaced, kinds (those replaced, in order of their names).
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    none = F.array().cast("array<string>")
    found = texts.withColumn("matches", F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(ANY), 0)))
    found = found.withColumn("matches", F.coalesce("matches", none))
    named = found.withColumn("named", F.transform("matches", lambda m: F.struct(m.alias("old"), kind_of(m).alias("kind"))))
    new = named.withColumn(
        "new",
        F.transform(
            "named",
            lambda m: F.struct(
                m["old"].alias("old"), m["kind"].alias("kind"), pseudonym(m["old"], m["kind"], key).alias("new")
            ),
        ),
    )
    parts = F.zip_with(
        F.split("text", ANY), F.col("new.new"), lambda part, name: F.concat(part, F.coalesce(name, F.lit("")))
    )
    replaced = F.filter("new", lambda m: m["old"] != m["new"])
    return new.select(
        "doc_id",
        F.when(F.size("matches") == 0, F.col("text")).otherwise(F.array_join(parts, "")).alias("text"),
        F.size(replaced).cast("long").alias("n_replaced"),
        F.array_sort(F.array_distinct(F.transform(replaced, lambda m: m["kind"]))).alias("kinds"),
    )
