import datetime
import hashlib
import ipaddress
import random
import re

import pytest
from pyspark.sql import functions as F

from punktwerk.llm import pii
from tests.llm.conftest import edge_rows


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(d)) % 10 == 0


def card(rng, n=16):
    body = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(body + c for c in "0123456789" if luhn(body + c))


def run(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in sorted(pii.pseudonymise(df, key).collect(), key=lambda r: r.doc_id)]


def shape(s):
    return re.sub("[0-9]", "9", s)


def test_valid_values_change_and_keep_their_format(spark):
    rng = random.Random(1)
    values = [card(rng) for _ in range(30)] + [card(rng, n) for n in (13, 15, 19)] + ["4111 1111 1111 1111", "4111-1111-1111-1111"]
    for text, r in zip(values, run(spark, [f"pay {v} now" for v in values])):
        new = r.text[4:-4]
        assert r.n_card == 1 and new != text and shape(new) == shape(text) and luhn(new)


def test_other_kinds(spark):
    texts = ["call +1 (459) 555-9246 or (930) 555-2361.", "ip 83.229.25.121, 300.1.1.1 and 1.2.3.4.", "born 1999-02-28, not 1999-02-30; 28.02.1999",
             "id 123-45-6789 not 000-12-3456", 'token = "186661156f3f9905942d70850a01cbf23a203f82" x', "a.b@c.example.com A.B@C.EXAMPLE.COM!!"]
    r = run(spark, texts)
    assert [(x.n_found, x.n_phone, x.n_ip, x.n_date, x.n_national, x.n_secret, x.n_email) for x in r] == [
        (2, 2, 0, 0, 0, 0, 0), (2, 0, 2, 0, 0, 0, 0), (2, 0, 0, 2, 0, 0, 0), (1, 0, 0, 0, 1, 0, 0), (1, 0, 0, 0, 0, 1, 0), (2, 0, 0, 0, 0, 0, 2)]
    assert shape(r[0].text) == shape(texts[0]) and "555-9246" not in r[0].text
    assert "300.1.1.1" in r[1].text and "83.229" not in r[1].text
    assert all(int(o) < 256 for o in re.findall(r"\d+", r[1].text.replace("300.1.1.1", "")))
    iso, dotted = re.search(r"\d{4}-\d\d-\d\d", r[2].text).group(), re.search(r"\d\d\.\d\d\.\d{4}", r[2].text).group()
    assert datetime.date.fromisoformat(iso) == datetime.datetime.strptime(dotted, "%d.%m.%Y").date() and "1999-02-30" in r[2].text
    assert "000-12-3456" in r[3].text and "186661156f3f" not in r[4].text and re.search(r'token = "[0-9a-f]{40}" x', r[4].text)
    assert len(set(re.findall(r"user-[0-9a-f]+", r[5].text))) == 1          # equal values stay linked


def test_invalid_numbers_stay(spark):
    rng = random.Random(2)
    bad = [s for s in ("".join(rng.choice("0123456789") for _ in range(16)) for _ in range(40)) if not luhn(s)]
    assert [r.text for r in run(spark, bad)] == bad


def test_feistel_is_a_permutation(spark):
    df = spark.range(35).select(pii.feistel(F.col("id"), F.lit(5).cast("long"), F.lit(7).cast("long"), "k", F.lit("t")).alias("y"))
    assert sorted(r.y for r in df.collect()) == list(range(35))
    days = spark.sql("select explode(sequence(date'1900-01-01', date'2099-12-30', interval 97 days)) as d").select(
        F.date_format("d", "yyyy-MM-dd").alias("m")).select("m", pii._date(F.col("m"), "k").alias("y")).collect()
    assert len({r.y for r in days}) == len(days) and all(1900 <= int(r.y[:4]) <= 2099 for r in days)


def test_equal_values_link_and_keys_differ(spark):
    a = run(spark, ["x 83.229.25.121", "y 83.229.25.121 z"])
    assert a[0].text[2:] == a[1].text[2:-2]
    assert run(spark, ["x 83.229.25.121"], "other")[0].text != a[0].text


def test_edge_cases(edge, empty):
    rows = {r.doc_id: r for r in pii.pseudonymise(edge, "k").collect()}
    for r in edge_rows():
        assert rows[r[0]].text == r[1] and rows[r[0]].n_found == 0
    assert pii.pseudonymise(empty, "k").count() == 0
    out = pii.with_pseudonyms(edge.drop("found"), "k")
    assert set(edge.columns) == set(out.columns)


def test_long_text(spark):
    text = ("word " * 30000) + "83.229.25.121 " + ("word " * 30000)
    r = run(spark, [text])[0]
    assert r.n_ip == 1 and len(r.text.split()) == 60001 and "83.229.25.121" not in r.text


def test_plan_is_native(edge):
    plan = pii.pseudonymise(edge, "k")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def mod97(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def test_secrets_of_any_length_and_sign(spark):
    texts = ["password: hunter2", "password=Tr0ub4dor&3-horse next", "password=abcdefghijkl$tail", 'x "api_key": "two words" y', "DB_PASSWORD='it is' z",
             "secret:p@ss.word", 'token = "a\\"b c" d', "password := open"]
    clear = ["hunter2", "horse", "tail", "words", "it is", "p@ss", "b c", "open"]
    for t, c, r in zip(texts, clear, run(spark, texts)):
        assert r.n_secret == 1 and r.n_found == 1 and c not in r.text
    ends = [r.text for r in run(spark, texts)]
    assert ends[1].endswith(" next") and ends[3].endswith('" y') and ends[4].endswith("' z") and ends[6].endswith('" d')


def test_international_phones(spark):
    values = ["+44 20 7946 0958", "+33 6 12 34 56 78", "555.123.4567", "+442079460958", "+49 (30) 901820", "+1 459 555 9246"]
    rows = run(spark, [f"call {v}, now" for v in values])
    for v, r in zip(values, rows):
        assert r.n_phone == 1 and r.n_found == 1 and shape(r.text) == shape(f"call {v}, now") and v not in r.text
    assert rows[0].text[5:8] == "+44" and rows[1].text[5:8] == "+33"
    assert re.sub("[^0-9]", "", rows[0].text) == re.sub("[^0-9]", "", rows[3].text)     # one number, two groupings


def test_ibans(spark):
    good = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S", "PL61109010140000071219812874"]
    for v, r in zip(good, run(spark, [f"to {v} THE end" for v in good])):
        new = r.text[3:-8]
        assert r.n_iban == 1 and r.n_found == 1 and new != v and shape(new) == shape(v) and new[:2] == v[:2] and mod97(new) == 1
    assert run(spark, ["to DE88 3704 0044 0532 0130 00"])[0].n_found == 0


def test_ipv6(spark):
    import ipaddress
    good = ["2001:db8::8a2e:370:7334", "2001:0DB8:0:0:0:8a2e:370:7334", "fe80::1", "2001:db8:0:0:1:0:0:1"]
    rows = run(spark, [f"at {v}, ok" for v in good])
    new = [ipaddress.ip_address(r.text[3:-4]) for r in rows]
    assert all(r.n_ip == 1 and r.n_found == 1 for r in rows) and new[0] == new[1] and len(set(new)) == 3
    assert not {ipaddress.ip_address(v) for v in good} & set(new)
    bad = ["at 12:30:45, 00:1a:2b:3c:4d:5e", "a :: b", "std::vector<int>", "1::2::3"]
    assert [r.text for r in run(spark, bad)] == bad


def test_slash_dates(spark):
    a, b, c = run(spark, ["on 28/02/1999 x", "on 28.02.1999 x", "on 30/02/1999 x"])
    assert a.n_date == 1 and "28/02/1999" not in a.text and a.text.replace("/", ".") == b.text and c.text == "on 30/02/1999 x"


# --- a plain Python version of the whole operator ---------------------------

def sha(*parts):
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


def plain_feistel(x, a, b, key, tweak, digits=12):
    left, right = divmod(x, b)
    for i in range(10):
        if i % 2 == 0:
            left = (left + int(sha(key, tweak, i, right)[:digits], 16)) % a
        else:
            right = (right + int(sha(key, tweak, i, left)[:digits], 16)) % b
    return left * b + right


def plain_permuted(d, key, tweak):
    n = len(d)
    return str(plain_feistel(int(d), 10 ** (n // 2), 10 ** (n - n // 2), key, f"{tweak}{n}")).zfill(n)


def refill(m, digits):
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in m)


def plain_one(kind, m, key):
    """(kind or None, replacement) of a match of one pattern."""
    d = re.sub("[^0-9]", "", m)
    if kind == "email":
        a = re.match(r"(.*\.[A-Za-z]{2,})?", m).group()
        return ("email", f"user-{sha(key, 'email', a.lower())[:16]}@example.invalid{m[len(a):]}") if a else (None, m)
    if kind == "secret":
        name = re.match(pii._SECRET_NAME, m, re.A).group()
        v = m[len(name):]
        core = v.rstrip(",.;:!?)]}>")
        letters = all(c.isalpha() or c in "_.[|" for c in core)
        if not (name[-1] in "\"'" or ("=" in name and core.lower() not in pii._CONSTANTS)
                or not (letters or re.fullmatch("u?int(8|16|32|64)|float(32|64)|[0-9]{1,3}", core))):
            return None, m
        return "secret", name + (sha(key, "secret", v.lower()) + sha(key, "secret2", v.lower()))[:max(len(v), 12)]
    if kind == "ip":
        x = int(ipaddress.ip_address(m))
        return "ip", str(ipaddress.ip_address(plain_feistel(x, 65536, 65536, key, "ip")))
    if kind == "ipv6":
        try:
            x = int(ipaddress.ip_address(m))
        except ValueError:
            return None, m
        if sum(g != "" for g in m.split(":")) < 2 or not re.search("[0-9]", m):
            return None, m
        left, right, top = x >> 64, x & (1 << 64) - 1, 1 << 64
        for i in range(10):
            signed = lambda v: v - top if v >= top // 2 else v
            if i % 2 == 0:
                left ^= int(sha(key, "ipv6", i, signed(right))[:16], 16)
            else:
                right ^= int(sha(key, "ipv6", i, signed(left))[:16], 16)
        h = f"{left:016x}{right:016x}"
        return "ip", ":".join(h[i:i + 4] for i in range(0, 32, 4))
    if kind == "date":
        form = "%Y-%m-%d" if "-" in m else "%d/%m/%Y" if "/" in m else "%d.%m.%Y"
        try:
            day = (datetime.datetime.strptime(m, form).date() - datetime.date(1900, 1, 1)).days
        except ValueError:
            return None, m
        if day >= 184 * 397:
            return None, m
        return "date", (datetime.date(1900, 1, 1) + datetime.timedelta(plain_feistel(day, 184, 397, key, "date"))).strftime(form)
    if kind == "national":
        return "national", refill(m, plain_permuted(d, key, "national"))
    if kind == "card":
        if not luhn(d):
            return None, m
        body = plain_permuted(d[:-1], key, "card")
        return "card", refill(m, body + next(c for c in "0123456789" if luhn(body + c)))
    if kind == "phone":
        code = re.match(pii._COUNTRY, d).group() if m[0] == "+" else ""
        return "phone", refill(m, code + plain_permuted(d[len(code):], key, "phone"))
    if not 2 <= int(re.sub(" ", "", m)[2:4]) <= 98 or mod97(m) != 1 or len(d) < 8:
        return None, m
    d, n = d[2:], len(d) - 2
    tweak = "iban" + re.sub("[0-9]", "0", m.replace(" ", ""))
    y = plain_feistel(int(d), 10 ** (n // 2), 10 ** (n - n // 2), key, tweak, 15)
    body = str(y).zfill(n)
    return "iban", refill(m, f"{98 - mod97(refill(m, '00' + body)):02d}" + body)


def plain(text, key):
    """Text and kinds, pattern by pattern in the order of the operator."""
    out, kinds, at = [], [], 0
    for m in re.finditer("|".join(f"(?P<{k}>{v})" for k, v in pii.PATTERNS.items()), text, re.A):
        x = m.group()
        order = ["ip", "iban", "ipv6", "date", "national", "card", "phone"]
        k = "secret" if re.match(pii._SECRET_NAME, x, re.A) else "email" if "@" in x else next(
            k for k in order if re.fullmatch(pii.PATTERNS[k], x, re.A))
        kind, new = plain_one(k, x, key)
        out += [text[at:m.start()], new]
        kinds += [kind] * (kind is not None)
        at = m.end()
    return "".join(out) + text[at:], kinds


def check_plain(spark, texts, key="k"):
    hits = 0
    for t, r in zip(texts, run(spark, texts, key)):
        text, kinds = plain(t or "", key)
        assert (r.text or "", [f.kind for f in r.found]) == (text, kinds), t
        hits += len(kinds)
    return hits


def test_given_table_against_plain_python(spark, sf_docs):
    assert check_plain(spark, sf_docs["text"].tolist()) > 20


def test_mixtures_against_plain_python(spark):
    rng = random.Random(9)
    parts = ["a.b@c.example.com", "x@y.z", "m@n.co.1", "q@r.com-", "1.2.3.4", "1.2.3.4.5", "300.2.2.2", "+44 20 7946 0958", "(930) 555-2361", "555.123.4567",
             "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "DE88 3704 0044 0532 0130 00", "2001:db8::1", "::", "12:30:45", "1::2::3", "1999-02-28",
             "28.02.1999", "30/02/1999", "2099-12-31", "123-45-6789", "000-12-3456", "4111 1111 1111 1111", "4111111111111112", "password: hunter2",
             "password: str,", "token=abc", 'secret = "two words"', "api_key='open", "token", ":", "=", '"', "'", "word", "é", "\n", ",", ".", "("]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", ", "]) for _ in range(rng.randint(1, 9))) for _ in range(1500)]
    assert check_plain(spark, texts) > 1000


def test_what_stays_and_what_goes(spark):
    stays = ["def f(password: str, token: int) -> None:", "the secret: he left early", "Password: the cat sat", "token: Optional[str] = x", "secret: été",
             "password = None", "token: uint64", "the secret: 3 of them", "password strength", "class Token: pass", "token=null;", "tokens: a1"]
    assert [r.text for r in run(spark, stays)] == stays
    goes = {"password" + " " * 9 + "= hunter2secret": "hunter2", 'password="' + 'x\\"' * 600 + 'tail"': "tail", "password=" + "a'" * 100 + "tail z": "tail",
            "password:correct-horse": "horse", "token: abc123": "abc123", "secret=word": "word", 'api-key: "two words"': "two", "password=" + "\t" * 50 + "p4": "p4"}
    for t, r in zip(goes, run(spark, list(goes))):
        assert r.n_secret == 1 and goes[t] not in r.text, t


UNITS = ["a.", "a@", "x@a.b", "a-", "@", "1.", "1", "1 ", "12-", "+", "+1(2)", ":", "a:", "1::", "::1", "AB12 ", "DE89 3704 ", "01.", "(", ")-", "password",
         "password=", "password ", "token:'", 'secret="', "\\", "'", '"', " ", "\t", "'x", '"\\', ",", "é", "a.a@a."]
FRONTS = ["x@", "x@a.", "password=", 'password="', "password='", "password", "+1 ", "DE89", "1.2.3.", "2001:", "4111 "]


@pytest.mark.parametrize("fronts, size", [([""], 1_000_000), (FRONTS, 50_000)])
def test_hostile_texts(spark, fronts, size):
    """A megabyte of one unit, and less behind the start of each format: no
    stack overflow, and time in proportion to the text."""
    texts = [front + unit * (size // len(unit)) for unit in UNITS for front in fronts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    assert pii.pseudonymise(df, "k").select(F.length("text").alias("n")).filter("n > 0").count() == len(texts)
