"""Small column expressions shared by the operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanbook import config

MONEY = "decimal(18,2)"
MONEY4 = "decimal(18,4)"


def dec(value: str, kind: str = MONEY) -> Column:
    return F.lit(value).cast(kind)


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("decimal(18,2)"))


def iif(cond: Column, yes: Column, no: Column) -> Column:
    return F.when(cond, yes).otherwise(no)


def clamp(c: Column, low: Column | None = None, high: Column | None = None) -> Column:
    if low is not None:
        c = F.greatest(low, c)
    if high is not None:
        c = F.least(high, c)
    return c


def pending(flag: Column, strict: bool = False) -> Column:
    """Not synced yet. Strict keeps 'N' only, so a null flag does not count."""
    return flag == "N" if strict else ~flag.eqNullSafe(F.lit("Y"))


def clean_id(c: Column) -> Column:
    return F.translate(c, " -", "")


def birthdate(national_id: Column) -> Column:
    """Birth date inside a 14-character national id (characters 4-9, DDMMYY).

    Two-digit years from 70 on belong to the 1900s, the others to the 2000s.
    """
    plain = F.regexp_replace(national_id, "[^A-Za-z0-9]", "")
    digits = F.substring(plain, 4, 6)
    year = F.substring(digits, 5, 2).try_cast("int")
    full = F.when(year >= 70, year + 1900).otherwise(year + 2000)
    text = F.concat_ws(
        "-", full.cast("string"), F.substring(digits, 3, 2), F.substring(digits, 1, 2)
    )
    usable = (F.length(plain) == 14) & digits.rlike("^[0-9]{6}$")
    return F.when(usable, text.try_cast("date"))


def split_coords(coords: Column) -> tuple[Column, Column]:
    return F.split_part(coords, F.lit("|"), F.lit(1)), F.split_part(coords, F.lit("|"), F.lit(2))


def map_link(coords: Column) -> Column:
    lat, lon = split_coords(coords)
    return F.concat(F.lit("https://maps.google.com/?q="), lat, F.lit(","), lon)


def json_fields(c: Column, names: list[str]) -> list[Column]:
    return [F.get_json_object(c, f"$['{n}']").alias(n.replace("-", "_")) for n in names]


def regex_match(c: Column, pattern: str) -> Column:
    return c.rlike(f"(?i){pattern}")


def gender_label(code: Column) -> Column:
    return (
        F.when(code == "F", "Femenino").when(code == "M", "Masculino").otherwise("Pendiente")
    )


def zone_label(code: Column) -> Column:
    return F.when(code == "U", "Urbano").when(code == "R", "Rural").otherwise("Pendiente")


def round_money(c: Column, digits: int = 2) -> Column:
    return F.round(c, digits)


def fixed_fx(amount: Column, rate: str = "35") -> Column:
    return F.round(amount / F.lit(rate).cast("decimal(10,4)"), 2)


def payment_term(n: Column) -> Column:
    out = F.lit(config.PAYMENT_TERM_DEFAULT)
    for days, code in config.PAYMENT_TERMS.items():
        out = F.when(n == days, F.lit(code)).otherwise(out)
    return out


def audit_append(log: Column, line: Column) -> Column:
    return F.concat(F.coalesce(log, F.lit("")), F.lit("\n"), F.coalesce(line, F.lit("")))


def risk_class(days: Column, what: str) -> Column:
    """Risk 'code', 'label' or 'rate' by days without payment."""
    index = {"code": 1, "label": 2, "rate": 3}[what]
    chain = None
    for row in config.RISK_CLASSES:
        value = dec(row[3], "decimal(5,2)") if what == "rate" else F.lit(row[index])
        if row[0] is not None:
            chain = (F if chain is None else chain).when(days <= row[0], value)
        else:
            chain = chain.when(days > config.RISK_CLASSES[-2][0], value)
    return chain


def emit(df, digits: int = 2):
    """Report form: every decimal becomes a double rounded to a fixed number of digits."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() == "decimal":
            c = F.round(c, digits).cast("double").alias(f.name)
        cols.append(c)
    return df.select(*cols)
