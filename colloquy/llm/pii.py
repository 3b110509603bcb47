"""Personal data replaced by format-preserving pseudonyms, with SQL functions only.

Numbers and dates are first validated (card numbers by the Luhn sum, IBANs modulo 97, dates by the calendar, social
security numbers, telephone numbers and IPv4 addresses by their ranges; ten bare digits only after a word for a telephone) and then permuted under a key within their format: the
value is split into two numbers below a and b, and ten Feistel rounds add a keyed SHA-256 of one, modulo a or b, to the other.
That is a bijection of the valid values, so equal values stay equal across documents, different ones stay different, lengths
and separators stay, and check digits are worked out anew.  E-mail addresses and secrets are no numbers: their letters and
digits come from a keyed hash, again the same one for the same value.

A date in figures that is one only with the month first (12/31/2020) is permuted among such dates, by class of its day, so that it never
meets a date with the day first.

Rules: null text stays null, empty text stays empty; digits that validate as nothing stay as they are; where patterns could
overlap the earlier kind in KINDS wins; text around a match is kept byte for byte.  Texts and secrets of any length are read
whole.  Repeated rows are treated alike, an empty table gives an empty one, and columns of any name are kept.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, table

#: The default key of tests and queries; a deployment passes its own.
KEY = "colloquy-demo-key"
ROUNDS = 10
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: In this order; the pattern of each kind.
KINDS = {
    "secret": r"""(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}["']?[A-Za-z0-9_+/-]{16,}+["']?)|\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36,}+|\bsk-[A-Za-z0-9_-]{20,}+""",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}-]{1,63}+\.){1,8}[A-Za-z]{2,24}(?![\p{L}\p{N}])",
    "iban": r"\b[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})\b",
    "phone": r"(?<![\d+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?[ .-]?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])|[2-9]\d{2}[2-9]\d{6}(?!\d)(?<=(?i:phone|tel|call|mobile|cell)[ .:#]{1,3}\d{10})",
    "card": r"(?<![\d.-])(?:\d{13,19}|\d{4}([ -])\d{4}\g1\d{4}\g1\d{4}|\d{4}([ -])\d{6}\g2\d{5})(?![\d-])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ipv4": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
}
#: What a text must hold for each kind to match; other texts skip the patterns.
_NEEDS = {"secret": r"(?i:token|secret|passw|key)|AKIA|gh[pousr]_|sk-", "email": "@"}
#: Country codes of one, two and three digits (fixed values).
_COUNTRY = "[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
#: Dates are days from this day on; their number is 17 * 4297, the days of 1900 to 2099.
_DAY_ZERO, _DAYS = "1900-01-01", (17, 4297)


def pattern() -> str:
    """All kinds as one Java pattern, with a group around it."""
    out, groups = [], 1
    for body in KINDS.values():
        count = len(re.findall(r"(?<!\\)\((?!\?)", body))
        out.append(re.sub(r"\\g(\d)", lambda m, base=groups: "\\" + str(base + int(m[1])), body))
        groups += count
    return "(" + "|".join(out) + ")"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """body with name bound to value, worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _chars(s: str) -> str:
    return f"transform(sequence(1, length({s})), i_ -> substr({s}, i_, 1))"


def _keyed(key: str, kind: str, *parts: str) -> str:
    return f"sha2(concat_ws(':', {_quoted(key)}, {_quoted(kind)}, {', '.join(parts)}), 256)"


def _feistel(key: str, kind: str, x: str, y: str, a: str, b: str) -> str:
    """The struct (l, r) that x below a and y below b are permuted to."""
    f = lambda v: f"cast(conv(substr({_keyed(key, kind, 'cast(n_ as string)', f'cast({v} as string)')}, 1, 15), 16, 10) as bigint)"
    return (
        f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('l', cast({x} as bigint), 'r', cast({y} as bigint)), (s_, n_) -> if(n_ % 2 = 0, "
        f"named_struct('l', (s_.l + {f('s_.r')}) % {a}, 'r', s_.r), named_struct('l', s_.l, 'r', (s_.r + {f('s_.l')}) % {b})))"
    )


def _digits_permuted(key: str, kind: str, d: str) -> str:
    """A string of 2 to 36 digits, permuted among those of its length."""
    h = f"(length({d}) - length({d}) div 2)"
    ten = lambda n: f"cast(rpad('1', cast({n} + 1 as int), '0') as bigint)"
    made = _feistel(key, kind, f"substr({d}, 1, {h})", f"substr({d}, {h} + 1)", ten(h), ten(f"length({d}) div 2"))
    return _let(made, "p_", f"concat(lpad(cast(p_.l as string), {h}, '0'), lpad(cast(p_.r as string), length({d}) div 2, '0'))")


def _refilled(m: str, digits: str) -> str:
    """m with its digits replaced, in order, by those given."""
    return _let(digits, "f_", f"aggregate({_chars(m)}, named_struct('o', '', 'i', 1), (s_, c_) -> if(c_ between '0' and '9', named_struct('o', concat(s_.o, substr(f_, s_.i, 1)), 'i', s_.i + 1), named_struct('o', concat(s_.o, c_), 'i', s_.i))).o")


def _luhn(d: str, first: int) -> str:
    """The Luhn sum of d; first is 1 if its last digit counts once, 2 if twice."""
    return f"aggregate(transform({_chars(f'reverse({d})')}, (c_, k_) -> cast(c_ as int) * (1 + (k_ + {first - 1}) % 2)), 0, (s_, v_) -> s_ + v_ - if(v_ > 9, 9, 0))"


def _mod97(s: str) -> str:
    return f"aggregate({_chars(s)}, 0, (s_, c_) -> if(c_ between '0' and '9', (s_ * 10 + cast(c_ as int)) % 97, (s_ * 100 + ascii(c_) - 55) % 97))"


def _only_digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _replacements(key: str) -> list[tuple[str, str, str]]:
    """(kind, condition on m, replacement of m): SQL text; the condition tells the kind and validates."""
    d = _only_digits("m")
    compact = "replace(m, ' ', '')"
    country = f"regexp_extract(m, '^[+]({_COUNTRY})', 1)"
    national = f"substr({d}, length({country}) + 1)"
    date = """coalesce(try_to_date(m, 'yyyy-MM-dd'), try_to_date(m, 'dd/MM/yyyy'), try_to_date(m, 'dd.MM.yyyy'))"""
    form = "case when m like '%-%' then 'yyyy-MM-dd' when m like '%/%' then 'dd/MM/yyyy' else 'dd.MM.yyyy' end"
    day = f"datediff({date}, date'{_DAY_ZERO}')"
    area = "cast(substr(m, 1, 3) as bigint)"
    octet = lambda i: f"cast(split_part(m, '.', {i}) as bigint)"
    value = "regexp_extract(m, '([A-Za-z0-9_+/-]{16,})[\"\\']?$', 1)"
    # letters and digits of a keyed hash in the case and alphabet of the value; each 60 places take one hash
    stream = f"array_join(transform(sequence(0, length(v_) div 60), b_ -> substr({_keyed(key, 'secret', 'cast(b_ as string)', 'v_')}, 1, 60)), '')"
    secret = _let(value, "v_", _let(stream, "h_", "concat(substr(m, 1, instr(m, v_) - 1), if(v_ = upper(v_), upper(substr(h_, 1, length(v_))), substr(h_, 1, length(v_))), substr(m, instr(m, v_) + length(v_)))"))
    mail = _keyed(key, "email", "lower(m)")
    permuted_iban = _let(
        f"regexp_replace(substr({compact}, 5), '[^0-9]', '')",
        "d_",
        _let(
            f"concat(substr({compact}, 1, 2), '00', {_refilled(f'substr({compact}, 5)', _digits_permuted(key, 'iban', 'd_'))})",
            "n_iban",
            "concat(substr(n_iban, 1, 2), lpad(cast(98 - " + _mod97("concat(substr(n_iban, 5), substr(n_iban, 1, 4))") + " as string), 2, '0'), substr(n_iban, 5))",
        ),
    )
    spaced_iban = f"if(m like '% %', regexp_replace({permuted_iban}, '(.{{4}})(?!$)', '$1 '), {permuted_iban})"
    ssn = _feistel(key, "ssn", f"{area} - if({area} > 666, 2, 1)", "(cast(substr(m, 5, 2) as bigint) - 1) * 9999 + cast(substr(m, 8) as bigint) - 1", "898", "989901")
    permuted_ip = _feistel(key, "ipv4", f"{octet(1)} * 256 + {octet(2)}", f"{octet(3)} * 256 + {octet(4)}", "65536", "65536")
    days = _feistel(key, "date", f"{day} div {_DAYS[1]}", f"{day} % {_DAYS[1]}", str(_DAYS[0]), str(_DAYS[1]))
    year, month, day_of = ("cast(substr(m, 7) as bigint)", "cast(substr(m, 1, 2) as bigint)", "cast(substr(m, 4, 2) as bigint)")
    month_first = "m like '%/%' and try_to_date(m, 'MM/dd/yyyy') between date'1900-01-01' and date'2099-12-31' and "
    slashed = lambda mm, dd, yy: f"concat(lpad(cast({mm} as string), 2, '0'), '/', lpad(cast({dd} as string), 2, '0'), '/', cast({yy} as string))"
    long_months = "array(1, 3, 5, 7, 8, 10, 12)"
    # classes of days that only the second place can hold: 13 to 28 of any month, 29 February, other 29ths and 30ths, 31sts
    american = [
        (f"{day_of} <= 28", _feistel(key, "date 28", f"{year} - 1900", f"({month} - 1) * 16 + {day_of} - 13", "200", "192"), slashed("p_.r div 16 + 1", "p_.r % 16 + 13", "p_.l + 1900")),
        (f"{month} = 2", _feistel(key, "date 29", f"({year} - 1904) div 28", f"({year} - 1904) div 4 % 7", "7", "7"), slashed("2", "29", "p_.l * 28 + p_.r * 4 + 1904")),
        (f"{day_of} <= 30", _feistel(key, "date 30", f"{year} - 1900", f"{month} - if({month} > 2, 2, 1)", "200", "11"), slashed("p_.r + if(p_.r > 0, 2, 1)", day_of, "p_.l + 1900")),
        ("true", _feistel(key, "date 31", f"{year} - 1900", f"array_position({long_months}, cast({month} as int)) - 1", "200", "7"), slashed(f"element_at({long_months}, cast(p_.r + 1 as int))", "31", "p_.l + 1900")),
    ]
    shown = lambda kind: f"rlike(m, {_quoted('^(?:' + _alone(KINDS[kind]) + ')$')})"
    return [
        ("email", "m like '%@%'", f"concat('p', substr({mail}, 1, 12), '@d', substr({mail}, 13, 8), '.example')"),
        ("secret", shown("secret"), secret),
        ("iban", f"{shown('iban')} and length({compact}) between 15 and 34 and length(regexp_replace(substr({compact}, 5), '[^0-9]', '')) >= 2 and {_mod97(f'concat(substr({compact}, 5), substr({compact}, 1, 4))')} = 1", spaced_iban),
        ("phone", f"{shown('phone')} and length({d}) between 7 and 15 and length({national}) >= 2", _refilled("m", f"concat({country}, {_digits_permuted(key, 'phone', national)})")),
        ("ssn", f"{shown('ssn')} and {area} between 1 and 899 and {area} <> 666 and substr(m, 5, 2) <> '00' and substr(m, 8) <> '0000'", _let(ssn, "p_", "concat(lpad(cast(p_.l + if(p_.l >= 665, 2, 1) as string), 3, '0'), '-', lpad(cast(p_.r div 9999 + 1 as string), 2, '0'), '-', lpad(cast(p_.r % 9999 + 1 as string), 4, '0'))")),
        ("date", f"{shown('date')} and {date} between date'{_DAY_ZERO}' and date'2099-12-31'", _let(days, "p_", f"date_format(date_add(date'{_DAY_ZERO}', cast(p_.l * {_DAYS[1]} + p_.r as int)), {form})")),
        *(("date", f"{shown('date')} and {month_first}{which}", _let(made, "p_", new)) for which, made, new in american),
        ("card", f"{shown('card')} and {_luhn(d, 1)} % 10 = 0", _refilled("m", _let(_digits_permuted(key, "card", f"substr({d}, 1, length({d}) - 1)"), "q_", f"concat(q_, cast((10 - {_luhn('q_', 2)} % 10) % 10 as string))"))),
        ("ipv4", shown("ipv4"), _let(permuted_ip, "p_", "concat_ws('.', cast(p_.l div 256 as string), cast(p_.l % 256 as string), cast(p_.r div 256 as string), cast(p_.r % 256 as string))")),
    ]


def _alone(body: str) -> str:
    """A kind's pattern for a match taken out of its text: without a look at what stood around it, and with its own group numbers."""
    out, body = "", re.sub(r"\\g(\d)", r"\\\1", body)
    while look := re.search(r"\(\?<?[!=]", body):
        depth, end, listed = 1, look.end(), False
        while depth:
            c = body[end]
            if c == "\\":
                end += 1
            elif listed or c == "[":
                listed = c != "]"
            else:
                depth += (c == "(") - (c == ")")
            end += 1
        out, body = out + body[: look.start()], body[end:]
    return out + body


def _made(key: str, found: str) -> Column:
    """From the column found, an array of matches: array<struct<kind, was, now>>; kind is null for matches that don't validate."""
    rules = _replacements(key)
    rule = "case " + " ".join(f"when {cond} then {i}" for i, (_, cond, _) in enumerate(rules)) + " end"
    kind = "case k " + " ".join(f"when {i} then {_quoted(name)}" for i, (name, _, _) in enumerate(rules)) + " end"
    now = "case k " + " ".join(f"when {i} then {new}" for i, (_, _, new) in enumerate(rules)) + " else m end"
    return F.expr(f"transform(`{found}`, m -> " + _let(f"({rule})", "k", f"named_struct('kind', {kind}, 'was', m, 'now', {now})") + ")")


def replace_pii(docs: DataFrame, key: str = KEY, *, spans: bool = False) -> DataFrame:
    """docs with text pseudonymised; with spans=True also pii array<struct<kind, was, now>> of what was replaced.

    All other columns are kept; a column pii makes way for that of spans=True.
    """
    found = fresh(docs, "found")
    made = fresh(docs, "made")
    likely = F.col("text").rlike("[0-9]|" + "|".join(_NEEDS.values()))  # every kind but these two has digits
    out = docs.withColumn(found, F.when(likely, F.regexp_extract_all("text", F.lit(pattern()), F.lit(1))))
    out = out.withColumn(made, F.when(F.size(found) > 0, _made(key, found)))
    pieces = F.split("text", pattern(), -1)
    joined = F.concat_ws("", F.flatten(F.zip_with(pieces, F.col(made), lambda p, r: F.array(p, F.coalesce(r["now"], F.lit(""))))))
    out = out.withColumn("text", F.when(F.size(made) > 0, joined).otherwise(F.col("text")))
    if spans:
        out = out.withColumn("pii", F.coalesce(F.filter(made, lambda r: r["kind"].isNotNull()), F.expr("cast(array() as array<struct<kind string, was string, now string>>)")))
    return out.drop(found, made)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the pseudonymised text, and how many values of each kind were replaced."""
    out = replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), spans=True)
    count = lambda kind: F.size(F.filter("pii", lambda r: r["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", "text", F.size("pii").cast("long").alias("n_replaced"), *(count(k) for k in KINDS))
