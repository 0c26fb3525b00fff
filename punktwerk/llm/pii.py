"""Pseudonyms for personal data, by a format-preserving Feistel network.

Numbers are found by pattern and then validated: payment cards by their
length, grouping and Luhn digit, IBANs by their country's length and mod 97,
IPv4 addresses by their octets, IPv6 addresses by their groups, national
numbers by their reserved ranges, dates by the calendar, phone numbers by
their grouping or, with a country code, their number of digits. What fails stays as it is. A valid value is an integer in
``Z_a x Z_b``; keyed rounds add a hash of one half to the other, modulo its
size, which is a permutation of that domain: the pseudonym has the same
format (a card keeps a right check digit, a date is a date), different
values never meet, and equal values get equal pseudonyms in every document.
E-mail addresses and the values of secrets (up to the closing quote or white
space) have no fixed domain; they get a keyed hash in their place. An unquoted
value behind a colon is a secret only if it has a digit or a sign, so prose
(``the secret: he left``) and annotations (``password: str``) stay; behind
``=`` anything but a constant such as ``None`` is one. Formats that stay
uncovered are listed in the README. Built from Column functions only.

No pattern has a length limit that its format doesn't set, and none repeats a
group in a way that needs stack or time beyond the text's length: repeated
groups are possessive or bounded by the format, runs of one class are
possessive, and what is long is validated after it was matched.

A null text stays null with nothing found; documents without personal data
keep their text unchanged. Rows are treated one by one: ties, repeated rows,
empty tables and extra columns need no care (extra columns are ignored by
``pseudonymise`` and kept by ``with_pseudonyms``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punktwerk.llm.common import prepare

ROUNDS = 10

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Length of an IBAN after its check digits -> countries.
_IBAN = {11: "NO", 12: "BE", 14: "DK|FI|FK|FO|GL|NL|SD", 15: "MK|SI", 16: "AT|BA|EE|KZ|LT|LU|MN|XK", 17: "CH|CR|HR|LI|LV",
         18: "BG|BH|DE|GB|GE|IE|ME|RS", 19: "AE|GI|IL|IQ|OM|SO|TL", 20: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 21: "LY|PT|ST", 22: "IS|TR",
         23: "BI|DJ|FR|GR|IT|MC|SM", 24: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV", 25: "BR|EG|PS|QA|UA", 26: "JO|KW|MU", 27: "MT|SC", 28: "LC", 29: "RU"}
_SECRET_NAME = r"(?i:(?<![A-Za-z0-9])(?:token|password|passwd|secret|api[_-]?key))[\"']?[ \t]*+(?::=|=>|==?|:)[ \t]*+[\"']?"
_COUNTRY = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: kind -> pattern. Kinds are tried in this order.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "secret": _SECRET_NAME + r"(?:(?<=\")(?:[^\"\\\n]++|\\.)++(?=\")|(?<=')(?:[^'\\\n]++|\\.)++(?=')|[^\s\"']++(?:[\"']++[^\s\"']++)*+)",
    "iban": r"(?<![0-9A-Za-z])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(f"(?:{c})[0-9]{{2}}(?: ?[0-9A-Z]){{{n}}}" for n, c in _IBAN.items()) + r")(?![0-9A-Za-z])",
    "phone": r"(?:(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?)(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
             r"|(?<![0-9A-Za-z+(])(?:\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9-])"
             r"|(?<![0-9A-Za-z+(.])[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?!\.?[0-9A-Za-z])"
             r"|(?<![0-9A-Za-z+])\+[1-9](?:(?:[ .-]?\(|\)[ .-]?|[ .-])?[0-9]){7,14}(?![0-9])",
    "ip": rf"(?<![0-9A-Za-z_.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9A-Za-z_])",
    "ipv6": r"(?<![0-9A-Za-z_:.])(?=[0-9A-Fa-f:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z_:]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z_-])(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9-])"
            r"|(?<![0-9A-Za-z_.])(?:0[1-9]|[12][0-9]|3[01])\.(?:0[1-9]|1[0-2])\.(?:19|20)[0-9]{2}(?![0-9])"
            r"|(?<![0-9A-Za-z_/.])(?:0[1-9]|[12][0-9]|3[01])/(?:0[1-9]|1[0-2])/(?:19|20)[0-9]{2}(?![0-9/])",
    "national": r"(?<![0-9A-Za-z_-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z_-])",
    "card": r"(?<![0-9A-Za-z_])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{5})(?![0-9A-Za-z_])",
}
KINDS = tuple(k for k in PATTERNS if k != "ipv6")       # counted as "ip"
ANY = "|".join(PATTERNS.values())
#: Every match of a pattern holds one of these; most texts hold none.
HINT = r"@|(?i:token|passw|secret|api[_-]?key)|[0-9](?:[ .()/-]{0,3}[0-9]){5}|[0-9]\.[0-9]{1,3}\.[0-9]|[A-Z]{2}[0-9]{2}|:[0-9A-Fa-f]{0,4}:"
#: Words that stand for no value at all.
_CONSTANTS = ("none", "null", "nil", "true", "false", "undefined")
_FIRST_DAY, _DAYS = "1900-01-01", (184, 397)      # 184 * 397 days: to 2099-12-30


def feistel(x: Column, a: Column, b: Column, key: str, tweak: Column, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of the integers below a * b. What the rounds need
    travels in the accumulator, so it is computed once."""
    def mixed(i, tweak_, v):
        h = F.sha2(F.concat_ws("|", F.lit(key), tweak_, i.cast("string"), v.cast("string")), 256)
        return F.conv(F.substring(h, 1, 12), 16, 10).cast("long")

    def state(s, left, right):
        return F.struct(left.alias("l"), right.alias("r"), s["a"].alias("a"), s["b"].alias("b"), s["t"].alias("t"))

    low = F.pmod(x, b)
    first = F.struct(F.call_function("div", x - low, b).alias("l"), low.alias("r"), a.alias("a"), b.alias("b"), tweak.alias("t"))
    return F.aggregate(
        F.array(*[F.lit(i) for i in range(rounds)]), first,
        lambda s, i: F.when(i % 2 == 0, state(s, F.pmod(s["l"] + mixed(i, s["t"], s["r"]), s["a"]), s["r"]))
                      .otherwise(state(s, s["l"], F.pmod(s["r"] + mixed(i, s["t"], s["l"]), s["b"]))),
        lambda s: s["l"] * s["b"] + s["r"])


def _wide(left: Column, right: Column, mixed, start: Column, rounds: int = ROUNDS) -> Column:
    """The struct (l, r) after keyed rounds over two halves that don't fit one
    integer together; ``mixed(state, i, half, side)`` gives a half's new value.
    What ``start`` holds travels along."""
    def state(s, l, r):
        return F.struct(l.alias("l"), r.alias("r"), s["c"].alias("c"))

    return F.aggregate(
        F.array(*[F.lit(i) for i in range(rounds)]), F.struct(left.alias("l"), right.alias("r"), start.alias("c")),
        lambda s, i: F.when(i % 2 == 0, state(s, mixed(s["c"], i, s["l"], s["r"], "a"), s["r"]))
                      .otherwise(state(s, s["l"], mixed(s["c"], i, s["r"], s["l"], "b"))))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refill(m: Column, digits: Column) -> Column:
    """The digits of m replaced in order; everything else stays."""
    def state(s, text, used):
        return F.struct(text.alias("o"), used.alias("i"), s["d"].alias("d"))

    return F.aggregate(
        F.split(m, ""), F.struct(F.lit("").alias("o"), F.lit(1).alias("i"), digits.alias("d")),
        lambda s, c: F.when(c.rlike("[0-9]"), state(s, F.concat(s["o"], F.substring(s["d"], s["i"], F.lit(1))), s["i"] + 1))
                      .otherwise(state(s, F.concat(s["o"], c), s["i"])),
        lambda s: s["o"])


def _luhn(body: Column, check_included: bool) -> Column:
    """Luhn sum modulo 10; without the check digit, of the body alone."""
    odd = 1 if check_included else 0
    weights = F.transform(F.split(F.reverse(body), ""), lambda c, i: F.when(
        i % 2 == odd, F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.pmod(F.aggregate(weights, F.lit(0), lambda s, v: s + v), F.lit(10))


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def _permuted(d: Column, key: str, tweak: str) -> Column:
    """A digit string permuted among all strings of its length."""
    n = F.length(d)
    half = F.shiftright(n, 1)
    y = feistel(d.cast("long"), _power(half), _power(n - half), key, F.concat(F.lit(tweak), n.cast("string")))
    return F.lpad(y.cast("string"), n, "0")


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    body = _permuted(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")
    check = F.pmod(10 - _luhn(body, False), F.lit(10)).cast("string")
    return _refill(m, F.concat(body, check))


def _phone(m: Column, key: str) -> Column:
    """The digits change; a country code stays."""
    d = _digits(m)
    code = F.when(m.startswith("+"), F.regexp_extract(d, _COUNTRY, 0)).otherwise(F.lit(""))
    return _refill(m, F.concat(code, _permuted(F.substring(d, F.length(code) + 1, F.length(d)), key, "phone")))


def _mod97(text: Column) -> Column:
    """Digits and letters (A = 10) as a number modulo 97."""
    return F.aggregate(F.split(text, ""), F.lit(0), lambda s, c: F.when(c == "", s).when(
        c.rlike("[0-9]"), (s * 10 + c.try_cast("int")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97))


def _iban_valid(m: Column) -> Column:
    c = F.regexp_replace(m, " ", "")
    check = F.substring(c, 3, 2)
    return check.between("02", "98") & (_mod97(F.concat(F.substring(c, F.lit(5), F.length(c)), F.substring(c, 1, 4))) == 1) & (
        F.length(_digits(m)) >= 8)


def _iban(m: Column, key: str) -> Column:
    """The account's digits change and get right check digits; the country and
    letters stay."""
    d = F.substring(_digits(m), F.lit(3), F.lit(40))
    n = F.length(d)
    half = F.shiftright(n, 1)
    a, b = _power(half), _power(n - half)

    def mixed(c, i, x, other, side):
        h = F.sha2(F.concat_ws("|", F.lit(key), c["t"], i.cast("string"), other.cast("string")), 256)
        return F.pmod(x + F.conv(F.substring(h, 1, 15), 16, 10).cast("long"), c[side])

    y = _wide(F.substring(d, F.lit(1), half).cast("long"), F.substring(d, half + 1, n).cast("long"), mixed,
              F.struct(a.alias("a"), b.alias("b"), F.concat(F.lit("iban"), F.regexp_replace(F.regexp_replace(m, " ", ""), "[0-9]", "0")).alias("t")))
    body = F.concat(F.lpad(y["l"].cast("string"), half, "0"), F.lpad(y["r"].cast("string"), n - half, "0"))
    made = F.regexp_replace(_refill(m, F.concat(F.lit("00"), body)), " ", "")
    check = 98 - _mod97(F.concat(F.substring(made, F.lit(5), F.length(made)), F.substring(made, 1, 4)))
    return _refill(m, F.concat(F.lpad(check.cast("string"), F.lit(2), "0"), body))


def _ipv6_valid(m: Column) -> Column:
    """Eight groups, or fewer with one ``::``; at least two that aren't empty,
    and a digit (no scope operator)."""
    groups = F.split(m, ":")
    full = F.size(F.filter(groups, lambda g: g != ""))
    gap = m.contains("::")
    return (F.when(gap, (full <= 7) & ~F.regexp_replace(m, "^(.*?)::", "$1;").contains("::") & ~m.rlike("^:[^:]|[^:]:$"))
            .otherwise((full == 8) & (F.size(groups) == 8))) & (full >= 2) & m.rlike("[0-9]")


def _ipv6(m: Column, key: str) -> Column:
    """128 bits in two halves; the pseudonym has all eight groups."""
    def padded(part):
        return F.aggregate(F.filter(F.split(part, ":"), lambda g: g != ""), F.lit(""), lambda s, g: F.concat(s, F.lpad(F.lower(g), F.lit(4), "0")))

    head, tail = padded(F.substring_index(m, "::", 1)), padded(F.when(m.contains("::"), F.substring_index(m, "::", -1)).otherwise(F.lit("")))
    bits = F.concat(head, F.rpad(F.lit(""), 32 - F.length(head) - F.length(tail), "0"), tail)

    def mixed(c, i, x, other, side):
        h = F.sha2(F.concat_ws("|", F.lit(key), F.lit("ipv6"), i.cast("string"), other.cast("string")), 256)
        return x.bitwiseXOR(F.conv(F.substring(h, 1, 16), 16, -10).cast("long"))

    y = _wide(*[F.conv(F.substring(bits, k, 16), 16, -10).cast("long") for k in (1, 17)], mixed, F.lit(0))
    out = F.lower(F.concat(F.lpad(F.hex(y["l"]), 16, "0"), F.lpad(F.hex(y["r"]), 16, "0")))
    return F.concat_ws(":", *[F.substring(out, 4 * k + 1, 4) for k in range(8)])


def _ip(m: Column, key: str) -> Column:
    half = F.lit(65536).cast("long")
    x = F.aggregate(F.split(m, r"\."), F.lit(0).cast("long"), lambda s, o: s * 256 + o.cast("long"))
    y = feistel(x, half, half, key, F.lit("ip"))
    return F.concat_ws(".", *[F.pmod(F.shiftright(y, k), F.lit(256)).cast("string") for k in (24, 16, 8, 0)])


def _day(m: Column) -> Column:
    """Days since the first day; null if the calendar has no such date."""
    iso = F.when(m.contains("-"), m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    month = F.concat(F.substring(iso, 1, 7), F.lit("-01")).cast("date")
    d = F.date_add(month, F.substring(iso, 9, 2).cast("int") - 1)
    return F.when(F.month(d) == F.month(month), F.datediff(d, F.lit(_FIRST_DAY).cast("date"))).cast("long")


def _date(m: Column, key: str) -> Column:
    a, b = (F.lit(n).cast("long") for n in _DAYS)
    y = F.date_add(F.lit(_FIRST_DAY).cast("date"), feistel(_day(m), a, b, key, F.lit("date")).cast("int"))
    return F.when(m.contains("-"), F.date_format(y, "yyyy-MM-dd")).when(m.contains("/"), F.date_format(y, "dd/MM/yyyy")).otherwise(F.date_format(y, "dd.MM.yyyy"))


def _hash(m: Column, key: str, tweak: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), F.lower(m)), 256)


def _email(m: Column) -> Column:
    """The address in a match: up to the last part that can be a top domain."""
    return F.regexp_extract(m, r"^(.*\.[A-Za-z]{2,})", 1)


def _named(m: Column) -> tuple[Column, Column]:
    name = F.regexp_extract(m, _SECRET_NAME, 0)
    return name, F.substring(m, F.length(name) + 1, F.length(m))


def _secret_valid(m: Column) -> Column:
    name, value = _named(m)
    core = F.rtrim(value, F.lit(",.;:!?)]}>"))
    plain = core.rlike(r"^[\p{L}\p{M}_.\[|]*+$|^u?int(?:8|16|32|64)$|^float(?:32|64)$|^[0-9]{1,3}$")
    return name.rlike("[\"']$") | (name.contains("=") & ~F.lower(core).isin(*_CONSTANTS)) | ~plain


def _secret(m: Column, key: str) -> Column:
    name, value = _named(m)
    h = F.concat(_hash(value, key, "secret"), _hash(value, key, "secret2"))
    # a short one's place would not hold a hash
    return F.concat(name, F.substring(h, F.lit(1), F.greatest(F.length(value), F.lit(12))))


def kind(m: Column) -> Column:
    """The kind of a match, null if it is not valid."""
    def whole(k):
        return m.rlike(rf"^(?:{PATTERNS[k]})$")
    days = _DAYS[0] * _DAYS[1]
    return (F.when(m.rlike("^" + _SECRET_NAME), F.when(_secret_valid(m), "secret"))
            .when(m.contains("@"), F.when(_email(m) != "", "email")).when(whole("ip"), "ip")
            .when(whole("iban"), F.when(_iban_valid(m), "iban"))
            .when(whole("ipv6"), F.when(_ipv6_valid(m), "ip"))
            .when(whole("date"), F.when(_day(m).between(0, days - 1), "date"))
            .when(whole("national"), "national")
            .when(whole("card"), F.when(_luhn(_digits(m), True) == 0, "card"))
            .when(whole("phone"), "phone"))


def pseudonym(m: Column, k: Column, key: str) -> Column:
    address = _email(m)
    return (F.when(k == "email", F.concat(F.lit("user-"), F.substring(_hash(address, key, "email"), 1, 16), F.lit("@example.invalid"),
                                          F.substring(m, F.length(address) + 1, F.length(m))))
            .when(k == "secret", _secret(m, key)).when((k == "ip") & m.contains(":"), _ipv6(m, key)).when(k == "ip", _ip(m, key)).when(k == "iban", _iban(m, key)).when(k == "date", _date(m, key))
            .when(k == "national", _refill(m, _permuted(_digits(m), key, "national")))
            .when(k == "card", _card(m, key)).when(k == "phone", _phone(m, key)).otherwise(m))


def with_pseudonyms(df: DataFrame, key: str, text: str = "text", out: str = "text", found: str = "found") -> DataFrame:
    """Replaces (or adds) the text with pseudonyms and the list of
    (kind, pseudonym) found, in order."""
    t = F.col(text)
    raw = F.when(t.rlike(HINT), F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    made = df.withColumn("_raw", raw).withColumn("_kinds", F.transform("_raw", kind)).withColumn(
        "_new", F.zip_with("_raw", "_kinds", lambda m, k: pseudonym(m, k, key)))
    # the text between the matches, and the matches' replacements
    rest = F.split(t, ANY, -1)
    text_ = F.when(F.size("_raw") > 0, F.array_join(F.flatten(F.zip_with(rest, "_new", lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")).otherwise(t)
    pairs = F.filter(F.zip_with("_kinds", "_new", lambda k, n: F.struct(k.alias("kind"), n.alias("pseudonym"))), lambda p: p["kind"].isNotNull())
    return made.withColumn(out, text_).withColumn(found, pairs).drop("_raw", "_kinds", "_new")


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text, n_found and a count per kind."""
    prepare(docs.sparkSession)
    d = with_pseudonyms(docs.select("doc_id", "text"), key)
    counts = [F.size(F.expr(f"filter(found, p -> p.kind = '{k}')")).alias(f"n_{k}") for k in KINDS]
    return d.select("doc_id", "text", F.size("found").alias("n_found"), *counts, "found")
