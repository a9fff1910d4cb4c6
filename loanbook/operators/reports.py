"""Portfolio and collection reports.

Subtotals come from a rollup over rows that were first summed at the report's finest
level, so the rollup itself never multiplies loan rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.functions.dates import add_six_day
from loanbook.functions.scalars import (
    gender_label, json_fields, map_link, pending, risk_class, split_coords, zero_if_null, zone_label)
from loanbook.operators.balances import collected, day, owned, synced_balance, with_collected
from loanbook.operators.payments import prorata
from loanbook.operators.runs import packed, unpacked


def document_number() -> Column:
    return F.coalesce(F.col("local_id"), F.col("legacy_cartera_id")).cast("string")


def portfolio(loans, collections, partners_wide, as_of, branch=None, branch_of: str = "partner",
              since=None, sum_all: bool = False, positive_last: bool = True) -> DataFrame:
    """Loans granted up to a day with balance, maturity, days overdue and days without payment.

    ``sum_all`` sums every collection, even later ones, as some report layouts do; the last
    payment is always the last one up to the day.
    """
    cut = day(as_of)
    ln = loans.filter(F.col("fecha") <= cut)
    if since is not None:
        ln = ln.filter(F.col("fecha") >= day(since))
    if branch is not None and branch_of == "loan":
        ln = ln.filter(F.col("ad_org_id") == branch)
    if sum_all:
        agg = collections.groupBy(F.col("id_cartera").alias("legacy_cartera_id")).agg(
            F.sum("abono").cast("decimal(18,2)").alias("paid"),
            F.max(F.when(F.col("operacion") <= cut, F.col("operacion"))).alias("last_payment"),
            F.max(F.when((F.col("operacion") <= cut) & (F.col("abono") > 0), F.col("operacion")))
            .alias("last_positive"))
    else:
        agg = collected(collections, as_of)
    p = partners_wide
    if branch is not None and branch_of == "partner":
        p = p.filter(F.col("ad_org_trx_id") == branch)
    last = F.coalesce("last_positive" if positive_last else "last_payment", F.col("fecha"))
    paid = zero_if_null(F.col("paid"))
    due = add_six_day(F.col("fecha"), F.col("dias_cre"))
    p = p.select("c_bpartner_id", "codigo", "nombre", "taxid", "rubro", "ruta", "ad_org_trx_id", "sucursal")
    return (
        ln.join(agg, "legacy_cartera_id", "left").join(p, "c_bpartner_id")
        .select(
            F.col("legacy_cartera_id").alias("recid"), "c_bpartner_id", "codigo",
            F.col("nombre").alias("tercero"), F.col("taxid").alias("cedula"), "rubro", "ruta",
            "ad_org_trx_id", "sucursal", "ad_org_id", "isactive", "monto", "tasa", "fecha",
            F.year("fecha").alias("yy_fecha"), F.col("dias_cre").alias("plazo"),
            due.alias("fechavence"), F.greatest(F.lit(0), F.datediff(cut, due)).alias("diasvencimiento"),
            document_number().alias("documentno"), F.col("montototal").alias("debito"),
            paid.alias("credito"), (F.col("montototal") - paid).cast("decimal(18,2)").alias("saldo"),
            last.alias("fechaultimoabono"), F.datediff(cut, last).alias("sinabonar"))
    )


def open_only(rows) -> DataFrame:
    return rows.filter(F.col("saldo") != 0)


BRANCH_COLUMNS = ["recid", "fecha", "plazo", "fechavence", "diasvencimiento", "c_bpartner_id", "codigo",
                  "tercero", "documentno", "debito", "credito", "saldo", "fechaultimoabono", "ruta",
                  "sinabonar", "sucursal"]


def portfolio_branch(loans, collections, partners_wide, as_of, branch=None, sum_all=False) -> DataFrame:
    return open_only(portfolio(loans, collections, partners_wide, as_of, branch, sum_all=sum_all)
                     ).select(*BRANCH_COLUMNS)


def overdue_summary(rows, levels: list[str], threshold: int) -> DataFrame:
    """Loans, overdue loans, debit, balance and overdue balance with subtotals per level.

    Subtotal rows have null in the levels they sum over; ``nivel`` is the grouping id.
    """
    late = F.col("diasvencimiento") > threshold
    fine = rows.groupBy(*levels).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(late, 1)).alias("nv"),
        F.sum("debito").alias("d"), F.sum("saldo").alias("s"),
        F.sum(F.when(late, F.col("saldo"))).alias("v"))
    return fine.rollup(*levels).agg(
        F.grouping_id().cast("bigint").alias("nivel"), F.sum("n").alias("totalcreditos"),
        F.sum("nv").alias("creditosvencidos"), F.sum("d").alias("debito"),
        F.sum("s").alias("saldo_cxc"), zero_if_null(F.sum("v")).alias("saldo_vencido"))


def portfolio_branch_year(loans, collections, partners_wide, as_of, branch=None, threshold=15,
                          sum_all=False) -> DataFrame:
    """Branch x year x route with subtotals."""
    rows = open_only(portfolio(loans, collections, partners_wide, as_of, branch, sum_all=sum_all))
    return overdue_summary(rows, ["sucursal", "yy_fecha", "ruta"], threshold)


def portfolio_global(loans, collections, partners_wide, branches, since, as_of, threshold=30,
                     sum_all=False) -> DataFrame:
    """The same by the branch of the loan, for loans granted between two days."""
    rows = open_only(portfolio(loans, collections, partners_wide, as_of, since=since, sum_all=sum_all))
    named = rows.drop("sucursal").join(branches, "ad_org_id").withColumnRenamed(
        "org_name", "sucursal")
    return overdue_summary(named, ["sucursal", "yy_fecha", "ruta"], threshold)


def portfolio_risk(loans, collections, partners_wide, as_of) -> DataFrame:
    """As-of portfolio with balances by part, risk class A-E and provision."""
    live = loans.filter((F.col("monto") > 0) & (F.col("isactive") == "Y"))
    rows = open_only(portfolio(live, collections, partners_wide, as_of))
    late = F.col("sinabonar")
    principal, interest = prorata(F.col("credito"), F.col("tasa"))
    return rows.select(
        "recid", "fecha", "plazo", "fechavence", "diasvencimiento", "c_bpartner_id", "codigo", "cedula",
        "tercero", "documentno", "debito", "credito", F.col("monto").alias("capital"),
        (F.col("monto") * F.col("tasa")).alias("interes"), "saldo",
        (F.col("monto") - principal).alias("saldo_principal"),
        (F.col("monto") * F.col("tasa") - interest).alias("saldo_interes"),
        "fechaultimoabono", "ruta", "rubro", "sinabonar",
        risk_class(late, "code").alias("codigo_clasificacion"),
        risk_class(late, "label").alias("tipo_clasificacion"),
        (F.col("saldo") * risk_class(late, "rate")).alias("provision"))


def sorted_report(rows, by: str) -> DataFrame:
    """Order chosen by name, then days without payment, longest first."""
    first = {
        "cliente": [F.asc("tercero")], "saldo": [F.desc("saldo")], "fecha": [F.asc("fecha")],
        "ruta": [F.asc("ruta")],
    }[by]
    return rows.orderBy(*first, F.desc("sinabonar"), F.asc("recid"))


def maturing(loans, collections, partners_wide, today, days: int, branch=None) -> DataFrame:
    """Open loans maturing within some days before or after today."""
    rows = portfolio(loans, collections, partners_wide, today, branch)
    due = F.col("fechavence")
    return rows.filter(
        (F.col("saldo") > 0) & due.between(F.date_sub(day(today), days), F.date_add(day(today), days))
    ).withColumn("diasvencimiento", F.datediff(day(today), due)).select(*BRANCH_COLUMNS)


def promotion(loans, collections, partners_wide, limit, branch=None) -> DataFrame:
    """Partners with a residual balance up to a limit: latest loan, totals and delay.

    Partners without any collection have no balance here, as in the report.
    """
    agg = collected(collections).select("legacy_cartera_id", "paid", "last_positive")
    per_loan = loans.join(agg, "legacy_cartera_id", "left")
    latest = F.max_by(F.struct("legacy_cartera_id", "dias_cre", "fecha", "last_positive"),
                      F.struct("fecha", "legacy_cartera_id"))
    t = per_loan.groupBy("c_bpartner_id").agg(
        latest.alias("u"), F.sum("montototal").cast("decimal(28,2)").alias("montototal"),
        F.sum("paid").cast("decimal(28,2)").alias("cobrototal"),
        F.sum(F.col("montototal") - F.col("monto")).cast("decimal(28,2)").alias("interestotal"))
    t = t.withColumn("saldototal", F.col("montototal") - F.col("cobrototal")).filter(
        F.col("saldototal") <= F.lit(str(limit)).cast("decimal(18,2)"))
    p = partners_wide if branch is None else partners_wide.filter(F.col("ad_org_trx_id") == branch)
    return t.join(p, "c_bpartner_id").select(
        "c_bpartner_id", "codigo", "nombre", "ruta", "sucursal",
        F.col("u.legacy_cartera_id").alias("ud_id"), F.col("u.dias_cre").alias("dias_cre"),
        F.col("u.fecha").alias("ultimodesembolso"), "montototal", "cobrototal", "saldototal",
        "interestotal",
        F.datediff(F.col("u.last_positive"), add_six_day(F.col("u.fecha"), F.col("u.dias_cre")))
        .alias("dias_retraso"))


def no_payment_on(loans, collections, partners_wide, on_day, since, branch=None) -> DataFrame:
    """Open loans with earlier collections but none on the day."""
    w = with_collected(loans.filter(F.col("fecha").between(day(since), day(on_day))), collections, on_day)
    w = w.filter((F.col("last_payment") < day(on_day)) & (F.col("balance") > 0))
    p = partners_wide if branch is None else partners_wide.filter(F.col("ad_org_trx_id") == branch)
    due = add_six_day(F.col("fecha"), F.col("dias_cre"))
    idle = F.datediff(day(on_day), F.col("last_payment"))
    return w.join(p.select("c_bpartner_id", "codigo", "nombre", "ruta", "sucursal"), "c_bpartner_id").select(
        "sucursal", "codigo", F.col("nombre").alias("tercero"), "legacy_cartera_id", "fecha",
        F.col("dias_cre").alias("plazo"), due.alias("fechavence"),
        F.greatest(F.lit(0), F.datediff(day(on_day), due)).alias("diasvencimiento"),
        F.col("montototal").alias("debito"), F.col("paid").alias("credito"),
        F.col("balance").alias("saldocar"), "cuota", F.col("last_payment").alias("fechaultimoabono"),
        idle.alias("sinabonar"), (F.col("cuota") * idle).alias("montoretraso"), "ruta")


def loans_between(loans, partners_wide, start, end) -> DataFrame:
    """Loans granted between two days with labels."""
    p = partners_wide.select("c_bpartner_id", "codigo", "nombre", "ruta", "sucursal", "genero", "tipo_localizacion")
    return loans.filter(F.col("fecha").between(day(start), day(end))).join(p, "c_bpartner_id").select(
        "legacy_cartera_id", "c_bpartner_id", "codigo", "nombre", "fecha", "dias_cre", "monto",
        "valorinteres", "montototal", F.col("ruta").alias("nombreruta"),
        F.col("sucursal").alias("nombresucursal"), gender_label(F.col("genero")).alias("genero"),
        zone_label(F.col("tipo_localizacion")).alias("tipo_localizacion"))


def _collection_rows(collections, loans, partners_wide, users, branches, start, end, org=None) -> DataFrame:
    """Collections between two days with the balance of their loan at the end.

    Only the loans that were paid in the range need their balance, so the as-of aggregate is
    joined to those rows.
    """
    inside = collections.filter(F.col("operacion").between(day(start), day(end)))
    if org is not None:
        inside = inside.filter(F.col("ad_org_id") == org)
    paid = collected(collections, end).select("legacy_cartera_id", "paid")
    ln = loans.join(paid, "legacy_cartera_id").select(
        F.col("legacy_cartera_id").alias("id_cartera"), "c_bpartner_id", "monto", "valorinteres",
        "montototal", "dias_cre", "tasa",
        (F.col("montototal") - F.col("paid")).cast("decimal(18,2)").alias("saldoalcorte"))
    p = partners_wide.select("c_bpartner_id", "codigo", "nombre", "ruta", "genero", "tipo_localizacion")
    u = users.select(F.col("ad_user_id").alias("createdby"), "usuario")
    return (
        inside.drop("c_bpartner_id").join(ln, "id_cartera").join(p, "c_bpartner_id").join(u, "createdby")
        .join(branches, "ad_org_id")
    )


def collections_global(collections, loans, partners_wide, users, branches, start, end) -> DataFrame:
    rows = _collection_rows(collections, loans, partners_wide, users, branches, start, end)
    principal, interest = prorata(F.col("abono"), F.col("tasa"))
    return rows.select(
        "legacy_cobro_id", F.col("codigo").alias("codtercero"), F.col("nombre").alias("tercero"),
        "abono", F.col("monto").alias("capital"), F.col("valorinteres").alias("interes"), "montototal",
        "saldoalcorte", principal.alias("abono_a_capital"), interest.alias("abono_a_interes"),
        F.col("abono").alias("abono_total"), F.col("dias_cre").alias("plazo"), "tasa",
        F.col("operacion").alias("fecha"), F.col("usuario").alias("creadopor"),
        F.col("ruta").alias("nombreruta"), F.col("org_name").alias("nombresucursal"),
        gender_label(F.col("genero")).alias("genero"),
        zone_label(F.col("tipo_localizacion")).alias("tipo_localizacion"))


def collections_branch(collections, loans, partners_wide, users, branches, start, end, config_json: str,
                       org=None) -> DataFrame:
    """Collections of a branch with coordinates and the tenant's configured names."""
    rows = _collection_rows(collections, loans, partners_wide, users, branches, start, end, org)
    lat, lon = split_coords(F.col("coords"))
    return rows.select(
        "legacy_cobro_id", F.col("codigo").alias("codtercero"), F.col("nombre").alias("tercero"), "abono",
        "montototal", "saldoalcorte", F.col("operacion").alias("fecha"),
        F.col("usuario").alias("creadopor"), F.col("ruta").alias("nombreruta"),
        F.col("org_name").alias("nombresucursal"), lat.alias("latitud"), lon.alias("longitud"),
        map_link(F.col("coords")).alias("coordenadalink"),
        *json_fields(F.lit(config_json), ["company-name", "rep-name"]))


def route_subtotals(rows) -> DataFrame:
    """Count and amount per branch and route with subtotals."""
    fine = rows.groupBy("nombresucursal", "nombreruta").agg(
        F.count(F.lit(1)).alias("n"), F.sum("abono").alias("a"))
    return fine.rollup("nombresucursal", "nombreruta").agg(
        F.grouping_id().cast("bigint").alias("nivel"), F.sum("n").alias("cobros"), F.sum("a").alias("abono"))


def payment_plan(schedule, loans, partners, branches, loan_id=None) -> DataFrame:
    """Instalments with their principal part, interest and total of the day.

    Loans get their names first, and the instalments meet them in runs: each takes hardly a byte of the only shuffle they pass.
    """
    ln = loans if loan_id is None else loans.filter(F.col("legacy_cartera_id") == loan_id)
    head = ln.select("legacy_cartera_id", "c_bpartner_id", "ad_org_id", (F.col("tasa") * 100).alias("tasa"),
                     "fecha", "monto", "cuota", "dias_cre", "valorinteres", "montototal")
    named = head.join(partners.select("c_bpartner_id", F.col("codigo").alias("bpartner_value"),
                                      F.col("nombre").alias("bpartner_name")), "c_bpartner_id").join(branches, "ad_org_id")
    s = schedule.select("legacy_cartera_id", "seq", "duedate", "dueamt")
    return (
        unpacked(packed(s, ["legacy_cartera_id"]).join(named, "legacy_cartera_id"), s, ["seq", "duedate", "dueamt"])
        .select("bpartner_value", "bpartner_name", "legacy_cartera_id", "seq", "tasa", "fecha", "monto",
                "cuota", (F.col("cuota") - F.col("dueamt")).alias("cuota_principal"), "dias_cre",
                "valorinteres", "montototal", "duedate", "dueamt",
                (F.col("cuota") + F.col("dueamt")).alias("cuota_total_dia"),
                F.col("org_name").alias("nombre_organizacion"))
    )


def _pending_counts(collections, keep_loans, partners) -> DataFrame:
    c = collections.filter(pending(F.col("synced")) & (F.col("origen") == "native") & (F.col("abono") > 0))
    n = c.groupBy(F.col("id_cartera").alias("legacy_cartera_id")).agg(F.count(F.lit(1)).alias("cobros"))
    return n.join(keep_loans, "legacy_cartera_id").join(
        partners.select("c_bpartner_id", "nombre"), "c_bpartner_id").select(
        "c_bpartner_id", "nombre", "cobros").distinct()


def pending_overpaid(collections, loans, invoices, partners) -> DataFrame:
    """Pending collections by partner on overdrawn loans or on loans with a paid invoice."""
    inv = invoices.select(F.col("c_invoice_id").alias("local_id"), "ispaid")
    billed = synced_balance(loans, collections).join(inv, "local_id")
    overdrawn = billed.filter(F.col("saldo_synced") < 0).select("legacy_cartera_id", "c_bpartner_id")
    paid = billed.filter(F.col("ispaid") == "Y").select("legacy_cartera_id", "c_bpartner_id")
    return _pending_counts(collections, overdrawn, partners).withColumn(
        "motivo", F.lit("sobregirada")).unionByName(
        _pending_counts(collections, paid, partners).withColumn("motivo", F.lit("factura pagada")))


def receipt_differences(receipts, collections, partners) -> DataFrame:
    """Positive receipts against the amount of the collection they came from."""
    c = collections.filter(F.col("local_id").isNotNull()).select(
        F.col("local_id").alias("c_payment_id"), F.col("abono"))
    return receipts.filter(F.col("payamt") > 0).join(c, "c_payment_id", "left").join(
        partners.select("c_bpartner_id", "nombre"), "c_bpartner_id").select(
        "c_payment_id", "c_bpartner_id", "nombre", "docstatus", "payamt", "dateacct", "abono",
        (F.col("payamt") - F.col("abono")).alias("diff"))


def cobros_export(collections, loans, partners_wide, users, branches, on_day=None, org=None) -> DataFrame:
    """Flat export of native collections: separate date and time, coordinates and map link."""
    c = collections.filter((F.col("origen") == "native") & (F.col("abono") > 0))
    if on_day is not None:
        c = c.filter(F.col("operacion") == day(on_day))
    if org is not None:
        c = c.filter(F.col("ad_org_id") == org)
    lat, lon = split_coords(F.col("coords"))
    return (
        owned(c, loans).join(
            partners_wide.select("c_bpartner_id", "codigo", "nombre", "ruta"), "c_bpartner_id")
        .join(users.select(F.col("ad_user_id").alias("createdby"), "usuario"), "createdby", "left")
        .join(branches, "ad_org_id")
        .select(F.col("org_name").alias("orgname"), F.col("ruta").alias("nombreruta"),
                F.date_format("operacion", "yyyy-MM-dd").alias("fecha"),
                F.date_format("operacion_ts" if "operacion_ts" in collections.columns else "operacion", "HH:mm:ss").alias("hora"),
                F.col("codigo").alias("codtercero"), F.col("nombre").alias("tercero"), "c_bpartner_id",
                "abono", F.col("usuario").alias("creadopor"), lat.alias("latitud"), lon.alias("longitud"),
                map_link(F.col("coords")).alias("coordenadalink"), "legacy_cobro_id")
    )
