"""Format-preserving pseudonyms for personal data (operator 9, DataFrame functions only).

One pattern finds candidates; each is checked (Luhn digit of card numbers,
octets of IPv4 addresses, area, group and serial of social security numbers,
calendar dates) and, when it holds, replaced by a keyed permutation of the
values of its own format: a Feistel network over two mixed-radix halves. The
same value gets the same pseudonym in every document, two values never share
one, and :func:`unmask_digits` inverts it with the key. Candidates that fail
their check stay as they are. E-mail addresses have no numeric domain: they
get a keyed digest as local part under ``example.org``.

Edge cases: a null text stays null with counts 0; an empty text stays empty;
very long texts are matched whole; repeated rows are treated alike; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import documents, let, pick

ROUNDS = 8
# The registered query's key: its result must be repeatable. Real corpora need a key of their own.
QUERY_KEY = "pseudonyms"
# Days from 1900-01-01 to 2099-12-31: 17 * 4297.
DAY_RADICES = (17, 4297)

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}(?![A-Za-z0-9-])"
IPV4 = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)"
DATE = r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-]|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = r"(?:(?<![\w+])\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4})(?!\d)"
CARD = r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d]|-\d)"
ANY = "|".join((EMAIL, IPV4, DATE, SSN, PHONE, CARD))
KINDS = ("email", "ip", "date", "ssn", "phone", "card")


def _prf(key: str, tweak: Column, i: Column, half: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def feistel(a: Column, b: Column, radix_a: Column, radix_b: Column, tweak: Column, key: str, inverse: bool = False) -> Column:
    """Keyed permutation of the pairs ``(a, b)`` with ``a < radix_a`` and ``b < radix_b``."""
    sign = F.lit(-1 if inverse else 1)

    def step(s, i):
        into_a = F.struct(F.pmod(s["a"] + sign * F.pmod(_prf(key, tweak, i, s["b"]), radix_a), radix_a).alias("a"), s["b"].alias("b"))
        into_b = F.struct(s["a"].alias("a"), F.pmod(s["b"] + sign * F.pmod(_prf(key, tweak, i, s["a"]), radix_b), radix_b).alias("b"))
        return F.when(i % 2 == 0, into_a).otherwise(into_b)

    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b")), step)


def mask_digits(digits: Column, tweak: Column, key: str, inverse: bool = False) -> Column:
    """A string of 2 to 18 digits, permuted among the strings of that length."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    right = n - left
    a, b = F.substring(digits, F.lit(1), left).cast("bigint"), F.substring(digits, left + 1, right).cast("bigint")
    power = lambda k: F.pow(F.lit(10.0), k).cast("bigint")
    out = feistel(a, b, power(left), power(right), F.concat(tweak, n.cast("string")), key, inverse)
    return let(out, lambda s: F.concat(F.lpad(s["a"].cast("string"), left, F.lit("0")), F.lpad(s["b"].cast("string"), right, F.lit("0"))))


def unmask_digits(digits: Column, tweak: Column, key: str) -> Column:
    return mask_digits(digits, tweak, key, inverse=True)


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    step = lambda acc, c: F.when(
        c.rlike(r"^\d$"), F.struct(F.concat(acc["out"], F.substring(digits, acc["i"], F.lit(1))).alias("out"), (acc["i"] + 1).alias("i"))
    ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["i"].alias("i")))
    return F.aggregate(F.split(shape, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("i")), step, lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit is not doubled."""
    n = F.length(digits)
    value = lambda c, i: let(c.cast("int") * F.when((n - 1 - i) % 2 == 1, 2).otherwise(1), lambda v: v - F.when(v > 9, 9).otherwise(0))
    return F.aggregate(F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), value), F.lit(0), lambda acc, v: acc + v)


def mask_card(s: Column, key: str) -> Column:
    """All digits but the last are permuted, the last is the Luhn digit of the rest."""

    def masked(d):
        body = mask_digits(F.substring(d, F.lit(1), F.length(d) - 1), F.lit("card"), key)
        return let(body, lambda x: refill(s, F.concat(x, F.pmod(F.lit(10) - luhn_sum(F.concat(x, F.lit("0"))) % 10, F.lit(10)).cast("string"))))

    return let(digits_of(s), masked)


def is_card(digits: Column) -> Column:
    return F.length(digits).between(13, 19) & (luhn_sum(digits) % 10 == 0) & ~digits.rlike(r"^(\d)\1*$")


def card_part(s: Column) -> Column:
    """The card in a run of digit groups: all of it, or else the longest stretch of whole groups that is one (the first of equal ones)."""

    def longest(tokens):
        last = F.floor((F.size(tokens) - 1) / 2).cast("int")
        cut = lambda i, j: F.array_join(F.slice(tokens, 2 * i + 1, 2 * (j - i) + 1), "")
        runs = F.flatten(F.transform(F.sequence(F.lit(0), last), lambda i: F.transform(F.sequence(i, last), lambda j: cut(i, j))))
        cards = F.filter(runs, lambda run: let(digits_of(run), is_card))
        size = lambda run: F.length(digits_of(run))
        return F.aggregate(cards, F.lit(None).cast("string"), lambda best, run: F.when(best.isNull() | (size(run) > size(best)), run).otherwise(best))

    return F.when(let(digits_of(s), is_card), s).otherwise(let(F.regexp_extract_all(s, F.lit(r"\d+|[ -]"), F.lit(0)), longest))


def mask_ip(s: Column, key: str) -> Column:
    def masked(o):
        octet = lambda i: F.get(o, F.lit(i)).cast("bigint")
        out = feistel(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), F.lit(65536), F.lit(65536), F.lit("ip"), key)
        return let(out, lambda v: F.concat_ws(".", *[x.cast("string") for half in ("a", "b") for x in (F.floor(v[half] / 256), v[half] % 256)]))

    return let(F.split(s, r"\."), masked)


def mask_ssn(s: Column, key: str) -> Column:
    """Valid areas (1 to 899 but 666), groups and serials are permuted among themselves."""

    def masked(p):
        number = lambda i: F.get(p, F.lit(i)).cast("bigint")
        area = number(0) - F.when(number(0) > 666, 2).otherwise(1)
        out = feistel(area * 99 + number(1) - 1, number(2) - 1, F.lit(898 * 99), F.lit(9999), F.lit("ssn"), key)
        new_area = lambda v: let(F.floor(v["a"] / 99), lambda x: x + F.when(x + 1 >= 666, 2).otherwise(1))
        return let(out, lambda v: F.concat_ws("-", F.lpad(new_area(v).cast("string"), 3, "0"), F.lpad((v["a"] % 99 + 1).cast("string"), 2, "0"), F.lpad((v["b"] + 1).cast("string"), 4, "0")))

    return let(F.split(s, "-"), masked)


def parse_date(s: Column) -> Column:
    part = lambda pos, n: F.substring(s, pos, n)
    iso = (
        F.when(s.rlike(r"^\d{4}"), F.concat_ws("-", part(1, 4), part(6, 2), part(9, 2)))
        .when(s.rlike(r"\."), F.concat_ws("-", part(7, 4), part(4, 2), part(1, 2)))
        .otherwise(F.concat_ws("-", part(7, 4), part(1, 2), part(4, 2)))
    )
    day_first = F.when(s.rlike(r"^\d{2}/"), F.concat_ws("-", part(7, 4), part(4, 2), part(1, 2)))
    return F.coalesce(iso.try_cast("date"), day_first.try_cast("date"))


def mask_date(s: Column, key: str) -> Column:
    day = F.datediff(parse_date(s), F.lit("1900-01-01").cast("date")).cast("bigint")
    low = DAY_RADICES[1]
    out = feistel(F.floor(day / low), day % low, F.lit(DAY_RADICES[0]), F.lit(low), F.lit("date"), key)
    new_day = let(out, lambda v: F.date_add(F.lit("1900-01-01").cast("date"), (v["a"] * low + v["b"]).cast("int")))
    return let(new_day, lambda d: F.when(s.rlike(r"^\d{4}-"), F.date_format(d, "yyyy-MM-dd")).when(s.rlike(r"^\d{4}/"), F.date_format(d, "yyyy/MM/dd"))
               .when(s.rlike(r"\."), F.date_format(d, "dd.MM.yyyy"))
               .when(F.substring(s, 1, 2).cast("int") > 12, F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "MM/dd/yyyy")))


def mask_email(s: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(s)), 256)
    return F.concat(F.lit("u"), F.substring(digest, 1, 16), F.lit("@example.org"))


def kind_of(s: Column) -> Column:
    """The kind of a candidate whose check holds, else null."""
    whole = lambda p: "^(?:" + p + ")$"
    octets_ok = F.forall(F.split(s, r"\."), lambda o: o.cast("int") <= 255)
    d = parse_date(s)
    ssn_ok = ~s.rlike(r"^(?:000|666|9)") & ~s.rlike(r"-00-") & ~s.rlike("0000$")
    return (
        F.when(s.contains("@"), "email")
        .when(s.rlike(whole(IPV4)), F.when(octets_ok, "ip"))
        .when(s.rlike(whole(DATE)), F.when((d >= F.lit("1900-01-01").cast("date")) & (d <= F.lit("2099-12-31").cast("date")), "date"))
        .when(s.rlike(whole(SSN)), F.when(ssn_ok, "ssn"))
        .when(s.rlike(whole(PHONE)), "phone")
        .otherwise(F.when(card_part(s).isNotNull(), "card"))
    )


def pseudonym(s: Column, kind: Column, key: str) -> Column:
    return (
        F.when(kind == "email", mask_email(s, key)).when(kind == "ip", mask_ip(s, key)).when(kind == "date", mask_date(s, key))
        .when(kind == "ssn", mask_ssn(s, key))
        .when(kind == "phone", let(digits_of(s), lambda d: refill(s, F.concat(F.substring(d, F.lit(1), F.length(d) - 10), mask_digits(F.substring(d, F.length(d) - 9, F.lit(10)), F.lit("phone"), key)))))
        .when(kind == "card", let(card_part(s), lambda part: let(F.instr(s, part), lambda at: F.concat(
            F.substring(s, F.lit(1), at - 1), mask_card(part, key), F.substring(s, at + F.length(part), F.length(s))))))
        .otherwise(s)
    )


def pseudonymise(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, the masked ``text`` and ``n_<kind>`` counts. Whoever has ``key`` can undo the permutations."""
    found = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all(F.col("text"), F.lit(ANY), F.lit(0)))
    typed = F.transform(found, lambda s: F.struct(s.alias("s"), kind_of(s).alias("kind")))
    hits = pick(docs, doc_id=doc_id, text=text).withColumn("hits", typed)
    between = F.split("text", ANY, -1)
    masked = F.transform(F.col("hits"), lambda h: pseudonym(h["s"], h["kind"], key))
    joined = F.array_join(F.zip_with(between, masked, lambda x, y: F.concat(x, F.coalesce(y, F.lit("")))), "")
    any_kind = F.exists(F.col("hits"), lambda h: h["kind"].isNotNull())

    def count_of(kind):
        return F.coalesce(F.size(F.filter(F.col("hits"), lambda h: h["kind"] == kind)), F.lit(0)).cast("bigint")

    counts = [count_of(k).alias(f"n_{k}") for k in KINDS]
    return hits.select("doc_id", F.when(any_kind, joined).otherwise(F.col("text")).alias("text"), *counts)


def op9_pii(spark, sf_dir: str) -> DataFrame:
    return pseudonymise(documents(spark, sf_dir), QUERY_KEY)
