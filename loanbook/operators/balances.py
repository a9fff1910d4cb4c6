"""As-of balances and the life of a loan.

Collections are always summed per loan before any join, so the join sees one row
per loan and a loan with very many collections costs no more than another.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook import config
from loanbook.functions.dates import maturity
from loanbook.functions.scalars import pending, split_coords, zero_if_null
from loanbook.operators.ordered import previous, tie_key, day_buckets


def day(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def owned(collections, loans) -> DataFrame:
    """Collections with their partner: their own column where they have one, else that of the loan."""
    if "c_bpartner_id" in collections.columns:
        return collections
    return collections.join(loans.select(F.col("legacy_cartera_id").alias("id_cartera"), "c_bpartner_id"), "id_cartera")


def collected(collections: DataFrame, as_of=None) -> DataFrame:
    """Per loan: collections up to a day (all when none is given).

    ``operacion`` is a date, as the readers give it; of a timestamp only midnight of the last day would count.
    """
    c = collections if as_of is None else collections.filter(F.col("operacion") <= day(as_of))
    return c.groupBy(F.col("id_cartera").alias("legacy_cartera_id")).agg(
        F.sum("abono").cast("decimal(18,2)").alias("paid"),
        F.max("operacion").alias("last_payment"),
        F.max(F.when(F.col("abono") > 0, F.col("operacion"))).alias("last_positive"),
        F.count(F.lit(1)).alias("n_payments"),
        F.count(F.when(F.col("abono") > 0, 1)).alias("n_positive"),
    )


def with_collected(loans: DataFrame, collections: DataFrame, as_of=None) -> DataFrame:
    """Loans with paid amount (0 if none), balance and last payment date (may be null)."""
    agg = collected(collections, as_of)
    return (
        loans.join(agg, "legacy_cartera_id", "left")
        .withColumn("paid", zero_if_null(F.col("paid")))
        .withColumn("n_payments", F.coalesce("n_payments", F.lit(0)))
        .withColumn("n_positive", F.coalesce("n_positive", F.lit(0)))
        .withColumn("balance", (F.col("montototal") - F.col("paid")).cast("decimal(18,2)"))
    )


def paid_to_date(loans, collections, as_of) -> DataFrame:
    return with_collected(loans, collections, as_of).select(
        "legacy_cartera_id", F.col("paid").alias("abonos"))


def balance_to_date(loans, collections, as_of) -> DataFrame:
    return with_collected(loans, collections, as_of).select(
        "legacy_cartera_id", F.col("balance").alias("saldo"))


def last_payment_to_date(loans, collections, as_of, fallback: bool = False) -> DataFrame:
    last = F.coalesce("last_payment", "fecha") if fallback else F.col("last_payment")
    return with_collected(loans, collections, as_of).select(
        "legacy_cartera_id", last.alias("fecha_ultimo_pago"))


def balances_at(loans, collections, dates: list[str]) -> DataFrame:
    """Balance of every loan at several days, from one pass over the collections.

    A collection is added once, to the first day that it counts for, found by halves; a running sum over the days of a loan
    then gives what was paid by each. The cost for a collection hardly depends on the number of
    days. Loans that start after a day have no row for it.
    """
    cuts = sorted(set(dates))
    ends = F.array(*[F.lit(d).cast("date") for d in cuts])
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    first = F.aggregate(halves, F.lit(0), lambda at, step: F.when(
        F.get(ends, at + step - 1) < F.col("operacion").cast("date"), at + step).otherwise(at))
    added = collections.filter(F.col("operacion") <= day(cuts[-1])).select(
        F.col("id_cartera").alias("legacy_cartera_id"), first.alias("_at"), "abono").groupBy("legacy_cartera_id", "_at").agg(
        F.sum("abono").alias("_sum"))
    # One entry for each day of a loan with collections.
    per_loan = added.groupBy("legacy_cartera_id").agg(F.map_from_entries(F.collect_list(F.struct("_at", "_sum"))).alias("_sums"))
    days = (
        loans.filter(F.col("fecha") <= day(cuts[-1]))
        .select("legacy_cartera_id", "fecha", "montototal")
        .join(per_loan, "legacy_cartera_id", "left")
        .select("legacy_cartera_id", "fecha", "montototal", "_sums", F.posexplode(ends).alias("_at", "corte")))
    upto = Window.partitionBy("legacy_cartera_id").orderBy("corte").rowsBetween(Window.unboundedPreceding, 0)
    paid = zero_if_null(F.sum(F.col("_sums")[F.col("_at")]).over(upto).cast("decimal(18,2)"))
    return (
        days.withColumn("abonos", paid)
        .filter(F.col("fecha") <= F.col("corte"))
        .select("legacy_cartera_id", "corte", "abonos",
                (F.col("montototal") - F.col("abonos")).cast("decimal(18,2)").alias("saldo"))
    )


def loan_metadata(loans, collections, id_range: tuple | None = None) -> DataFrame:
    """Life of a loan: settlement date once nothing is open, maturity, last payment, totals."""
    if id_range:
        keep = F.col("legacy_cartera_id").between(*id_range)
        loans = loans.filter(keep)
        collections = collections.filter(F.col("id_cartera").between(*id_range))
    w = with_collected(loans, collections)
    return w.select(
        "legacy_cartera_id",
        F.when(F.col("balance") <= 0, F.col("last_payment")).alias("fecha_cancelacion"),
        maturity(F.col("fecha"), F.col("dias_cre")).alias("fecha_vencimiento"),
        F.col("last_payment").alias("fecha_ultimo_pago"),
        F.col("paid").alias("total_abonos"),
        F.col("balance").alias("saldo_calculado"),
    )


def loan_renewal(loans, hot_rows=None) -> DataFrame:
    """New, renewal or reactivation by the gap to the partner's previous loan."""
    base = loans.select(
        "legacy_cartera_id", "c_bpartner_id", "fecha",
        maturity(F.col("fecha"), F.col("dias_cre"), "calendar").alias("vence"),
        tie_key("legacy_cartera_id").alias("_tie"))
    prev = previous(
        base, ["c_bpartner_id"], [F.col("fecha"), F.col("_tie"), F.col("legacy_cartera_id")],
        {"fecha_vence_anterior": "vence"}, day_buckets("fecha", "legacy_cartera_id"), hot_rows)
    return _classify(prev.drop("_tie"), F.datediff("fecha", "fecha_vence_anterior"))


def loan_renewal_strict(loans, hot_rows=None) -> DataFrame:
    """The same by the latest loan of a strictly earlier day."""
    base = loans.select(
        "legacy_cartera_id", "c_bpartner_id", "fecha", "dias_cre",
        maturity(F.col("fecha"), F.col("dias_cre"), "calendar").alias("vence"))
    per_day = base.groupBy("c_bpartner_id", "fecha").agg(
        F.max_by("vence", tie_key("legacy_cartera_id")).alias("vence_dia"))
    prev = previous(per_day, ["c_bpartner_id"], [F.col("fecha")],
                    {"fecha_vence_anterior": "vence_dia"}, [F.year("fecha")], hot_rows)
    joined = base.drop("dias_cre").join(
        prev.drop("vence_dia"), ["c_bpartner_id", "fecha"])
    return _classify(joined, F.datediff("fecha", "fecha_vence_anterior"))


def _classify(df, gap) -> DataFrame:
    diff = F.coalesce(gap, F.lit(config.NO_PREVIOUS_LOAN))
    kind = (
        F.when(gap.isNull(), config.LABEL_NEW)
        .when(gap <= config.RENEWAL_GAP_DAYS, config.LABEL_RENEWAL)
        .otherwise(config.LABEL_REACTIVATION)
    )
    return df.select(
        "legacy_cartera_id", "c_bpartner_id", "fecha", diff.cast("int").alias("diffdias"),
        kind.alias("tipodesembolso"))


def loan_view(loans, collections, partners_wide, users, renewal) -> DataFrame:
    """The wide loan view: partner, route, branch, user, totals and renewal class."""
    lat, lon = split_coords(F.col("coords"))
    w = with_collected(loans, collections)
    p = partners_wide.select("c_bpartner_id", "codigo", "nombre", "rubro", "cv_ruta_id", "ruta",
                             "sucursal")
    u = users.select(F.col("ad_user_id").alias("createdby"), "usuario")
    r = renewal.select("legacy_cartera_id", "diffdias", "tipodesembolso")
    return (
        w.join(p, "c_bpartner_id").join(u, "createdby").join(r, "legacy_cartera_id", "left")
        .select(
            "legacy_cartera_id", "ad_org_id", "dias_cre", "c_bpartner_id", "codigo", "fecha",
            F.col("nombre").alias("nombrecliente"), "monto", "tasa",
            F.round(F.col("monto") * F.col("tasa"), 2).alias("interes"), "montototal", "usuario",
            F.col("rubro").alias("grupotercero"), F.col("synced").alias("sincronizado"),
            "cv_ruta_id", F.col("ruta").alias("nombreruta"),
            F.col("sucursal").alias("nombresucursal"), lat.alias("latitud"), lon.alias("longitud"),
            maturity(F.col("fecha"), F.col("dias_cre"), "calendar").alias("fechavence"),
            "diffdias", "tipodesembolso",
            maturity(F.col("fecha"), F.col("dias_cre")).alias("fecha_vencimiento"),
            F.col("paid").alias("total_abonos"), F.col("last_payment").alias("fecha_ultimo_pago"),
            F.col("balance").alias("saldo_calculado"),
        )
    )


def partner_balance(loans, collections) -> DataFrame:
    """Loans minus collections per partner, for partners that have a loan.

    Collections are summed per loan first; the partner comes from the loan.
    """
    w = with_collected(loans.select("legacy_cartera_id", "c_bpartner_id", "montototal"), collections)
    return w.groupBy("c_bpartner_id").agg(F.sum("balance").cast("decimal(28,2)").alias("saldo"))


def partner_balance_check(partners, loans, collections) -> DataFrame:
    """Partners whose stored open balance differs."""
    b = partner_balance(loans, collections)
    return partners.select("c_bpartner_id", "nombre", "totalopenbalance").join(
        b, "c_bpartner_id").filter(F.col("saldo") != F.col("totalopenbalance"))


def partner_balance_fix(partners, loans, collections) -> DataFrame:
    """All partners, the stored balance replaced where it differs."""
    b = partner_balance(loans, collections)
    return (
        partners.join(b, "c_bpartner_id", "left")
        .withColumn("corregido", F.coalesce(F.col("saldo") != F.col("totalopenbalance"), F.lit(False)))
        .withColumn("totalopenbalance", F.coalesce("saldo", F.col("totalopenbalance")))
        .select("c_bpartner_id", "totalopenbalance", "corregido")
    )


def invoice_open(invoices, allocations, as_of=None) -> DataFrame:
    """Open amount per invoice: total minus active allocations (dated up to a day if given)."""
    al = allocations.filter(F.col("isactive") == "Y")
    if as_of is not None:
        al = al.filter(F.col("dateacct") <= day(as_of))
    done = al.groupBy("c_invoice_id").agg(F.sum("amount").cast("decimal(18,4)").alias("allocated"))
    return invoices.join(done, "c_invoice_id", "left").withColumn(
        "open", (F.col("grandtotal") - F.coalesce("allocated", F.lit(0))).cast("decimal(18,4)"))


def synced_balance(loans, collections) -> DataFrame:
    """Total minus synced collections, per loan."""
    agg = collections.filter(~pending(F.col("synced"))).groupBy(
        F.col("id_cartera").alias("legacy_cartera_id")).agg(
        F.sum("abono").cast("decimal(18,2)").alias("paid_synced"))
    return loans.join(agg, "legacy_cartera_id", "left").withColumn(
        "saldo_synced",
        (F.col("montototal") - zero_if_null(F.col("paid_synced"))).cast("decimal(18,2)"))
