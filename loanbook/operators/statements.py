"""Account statements: movements with running balances.

Rows of one day share a running balance in partner and loan statements. That of partners is computed on day totals (see
ordered.day_running) and joined back to the movements; that of loans so only where one is very large (ordered.with_day_running).
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanbook.functions.dates import add_six_day
from loanbook.functions.scalars import zero_if_null
from loanbook.operators.balances import collected, day, owned
from loanbook.operators.ordered import any_hot, day_buckets, day_running, running_total, tie_key, with_day_running
from loanbook.operators.payments import allocated_by_type
from loanbook import config
from loanbook.session import written

MON = "decimal(28,4)"


def _movement(df, document, concept, on, debit, credit):
    return df.select(
        "c_bpartner_id", document.alias("documentno"), F.lit(concept).alias("concepto"),
        on.alias("fecha"), debit.cast(MON).alias("debito"), credit.cast(MON).alias("credito"))


def partner_movements(loans, collections, start, end) -> DataFrame:
    """Opening debit and credit, then loans and collections of the range, without duplicates."""
    zero = F.lit(0)
    before = F.date_sub(day(start), 1)
    old_loans = loans.filter(F.col("fecha") < day(start)).groupBy("c_bpartner_id").agg(
        F.sum("montototal").alias("v"))
    # Earlier collections are summed, per loan or per partner, before they meet anything.
    keys = [c for c in ("id_cartera", "c_bpartner_id") if c in collections.columns]
    old_sums = collections.filter(F.col("operacion") < day(start)).groupBy(*keys).agg(F.sum("abono").alias("v"))
    old_paid = owned(old_sums, loans).groupBy("c_bpartner_id").agg(F.sum("v").alias("v"))
    new_loans = loans.filter(F.col("fecha").between(day(start), day(end)))
    new_paid = owned(collections.filter(F.col("operacion").between(day(start), day(end))), loans)
    parts = [
        _movement(old_loans, F.lit("INI-DEB"), "SALDO INICIAL (DÉBITOS)", before, F.col("v"), zero),
        _movement(old_paid, F.lit("INI-CRED"), "SALDO INICIAL (CRÉDITOS)", before, zero, F.col("v")),
        _movement(new_loans, F.coalesce("local_id", "legacy_cartera_id").cast("string"), "Desembolso",
                  F.col("fecha"), F.col("montototal"), zero),
        _movement(new_paid, F.coalesce("local_id", "legacy_cobro_id"), "Cobro", F.col("operacion"), zero,
                  F.col("abono")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def partner_statement(loans, collections, start, end, partner=None) -> DataFrame:
    if partner is not None:
        collections = owned(collections, loans).filter(F.col("c_bpartner_id") == partner)
        loans = loans.filter(F.col("c_bpartner_id") == partner)
    mov = written(partner_movements(loans, collections, start, end), "movements")  # read for the days and for the rows
    run = day_running(mov, ["c_bpartner_id"], "fecha", {
        "saldo": F.col("debito") - F.col("credito")}).drop("saldo_day")
    return mov.join(run, ["c_bpartner_id", "fecha"])


def partner_history(loans, collections, branches, partner=None, hot_rows=None) -> DataFrame:
    """Numbered loans of a partner with payments, balance, last payment and delay."""
    if partner is not None:
        loans = loans.filter(F.col("c_bpartner_id") == partner)
    agg = collected(collections).select("legacy_cartera_id", "paid", "last_positive")
    due = add_six_day(F.col("fecha"), F.col("dias_cre"))
    paid = zero_if_null(F.col("paid"))
    rows = loans.join(agg, "legacy_cartera_id", "left").join(branches, "ad_org_id").select(
        "c_bpartner_id", F.col("legacy_cartera_id").alias("idcartera"),
        F.col("org_name").alias("codsucursal"), "fecha", "dias_cre", due.alias("fechavence"), "monto",
        F.round(F.col("tasa") * 100, 2).alias("tasainteres"), "montototal", paid.alias("abonos"),
        (F.col("montototal") - paid).alias("saldo"), F.col("last_positive").alias("fechaultimoabono"),
        F.datediff(F.col("last_positive"), due).alias("dias_retraso"),
        tie_key("legacy_cartera_id").alias("_tie"))
    out = running_total(rows, ["c_bpartner_id"], [F.col("fecha"), F.col("_tie"), F.col("idcartera")],
                        {"rownumber": F.lit(1).cast("decimal(10,0)")}, day_buckets("fecha", "idcartera"), hot_rows)
    return out.drop("_tie").withColumn("rownumber", F.col("rownumber").cast("bigint"))


def loan_statement(loans, collections, schedule, invoices, allocations, loan_id=None, hot_rows=None) -> DataFrame:
    """Capital, interest and payment movements of a loan with three running balances.

    If a loan has more than ``HOT_ROWS`` instalments and payments, large loans go by day totals (ordered.with_day_running).
    """
    if loan_id is not None:
        loans = loans.filter(F.col("legacy_cartera_id") == loan_id)
        collections = collections.filter(F.col("id_cartera") == loan_id)
        schedule = schedule.filter(F.col("legacy_cartera_id") == loan_id)
    zero, key = F.lit(0).cast(MON), "legacy_cartera_id"
    inv = invoices.select("c_invoice_id", "dateinvoiced", "grandtotal", "c_doctype_id")
    # Loans and billed instalments meet their invoices in one join. Narrow rows go to their loan; the rest is made there.
    billed = schedule.filter(F.col("ref_invoice_id").isNotNull() & (F.col("processed") == "Y")).select(
        key, F.col("ref_invoice_id").alias("c_invoice_id"))
    total = F.col("montototal")
    asked = loans.select(key, F.col("local_id").alias("c_invoice_id"), F.lit(0).alias("orden"), "fecha", total.alias("total")).unionByName(
        billed.select(key, "c_invoice_id", F.lit(100).alias("orden"), F.lit(None).cast("date").alias("fecha"),
                      F.lit(None).cast(loans.schema["montototal"].dataType).alias("total")))
    met = asked.join(inv, "c_invoice_id", "left").filter((F.col("orden") == 0) | (F.col("c_doctype_id") == config.DOC_INTEREST))
    owed = met.select(
        key, "orden", F.coalesce("dateinvoiced", "fecha").alias("fecha_movimiento"), F.col("c_invoice_id").cast("string").alias("local"),
        F.coalesce("grandtotal", "total").alias("importe"))
    by_type = allocated_by_type(loans, schedule, allocations)
    amount = F.col("monto_asignado")
    split = by_type.groupBy(F.col("c_payment_id").alias("local_id"), key).agg(
        F.sum(F.when(F.col("c_doctype_id") == config.DOC_INTEREST, amount)).cast(MON).alias("ai"),
        F.sum(F.when(F.col("c_doctype_id") == config.DOC_CAPITAL, amount)).cast(MON).alias("ap"))
    # 998 are payments without an id of their own, which nothing is allocated from.
    paid = collections.filter(F.col("abono") > 0).select(
        F.col("id_cartera").alias(key), F.when(F.col("local_id").isNull(), 998).otherwise(999).alias("orden"), F.col("operacion").alias("fecha_movimiento"),
        F.coalesce("local_id", "legacy_cobro_id").alias("local"), F.col("abono").alias("importe"))
    values = {"saldo": F.col("debito") - F.col("credito"), "saldo_capital": F.col("_capital"), "saldo_interes": F.col("_interes")}

    def shown(df):
        first, last = F.col("orden") == 0, F.col("orden") >= 998
        ai, ap = F.coalesce("part.ai", zero), F.coalesce("part.ap", zero)
        debit = F.when(last, zero).otherwise(F.col("importe").cast(MON))
        document = F.when(first, F.coalesce("local", F.concat(F.lit("CAPITAL-"), F.col(key).cast("string")))).when(
            F.col("orden") == 998, F.concat(F.lit("COBRO-"), F.col("local"))).otherwise(F.col("local"))
        return df.select(
            key, "fecha_movimiento", F.when(last, 999).otherwise(F.col("orden")).alias("ordenpresentacion"), document.alias("documento"),
            F.when(first, "CxC Capital").when(last, "Pago/Cobro").otherwise("CxC Interés").alias("concepto"), debit.alias("debito"),
            F.when(last, F.col("importe").cast(MON)).otherwise(zero).alias("credito"), ai.alias("asignado_interes"), ap.alias("asignado_principal"),
            F.when(last, -ap).when(first, debit).otherwise(zero).cast(MON).alias("_capital"),
            F.when(last, -ai).when(first, zero).otherwise(debit).cast(MON).alias("_interes"))

    part = F.struct("ai", "ap").alias("part")
    nothing = F.lit(None).cast(split.select(part).schema["part"].dataType).alias("part")
    if any_hot([paid, billed], key, hot_rows):
        own = paid.join(loans.select(key), key, "left_semi").join(
            split.select(F.col("local_id").alias("local"), key, F.lit(999).alias("orden"), part), ["local", key, "orden"], "left")
        mov = written(shown(owed.select("*", nothing).unionByName(own)), "movements")  # read to find large loans and for the rows
        out = with_day_running(mov, key, "fecha_movimiento", values, hot_rows)
    else:
        # What was allocated goes along as rows of its own, so that one shuffle by loan does for everything.
        parts = split.filter(F.col("local_id").isNotNull()).select(
            key, F.lit(1000).alias("orden"), F.lit(None).cast("date").alias("fecha_movimiento"), F.col("local_id").alias("local"),
            F.lit(None).cast("decimal(18,2)").alias("importe"), part)
        every = owed.unionByName(paid).select("*", nothing).unionByName(parts).filter(F.col(key).isNotNull()).repartition(key)
        own, same = W.partitionBy(key), W.partitionBy(key, "local")
        every = every.withColumn("_known", F.max(F.col("orden") == 0).over(own)).withColumn(
            "part", F.when(F.col("orden") == 999, F.max(F.when(F.col("orden") == 1000, F.col("part"))).over(same)))
        upto = W.partitionBy(key).orderBy("fecha_movimiento").rangeBetween(W.unboundedPreceding, W.currentRow)
        out = shown(every.filter((F.col("orden") < 998) | ((F.col("orden") < 1000) & F.col("_known")))).withColumns(
            {n: F.sum(c).over(upto) for n, c in values.items()}).filter(F.col("fecha_movimiento").isNotNull())
    return out.drop("_capital", "_interes")


def _signed(df):
    inn = F.col("docbasetype") == "ARR"
    zero = F.lit(0).cast("decimal(18,2)")
    return df.withColumn("ingresos", F.when(F.col("docbasetype") == "APP", zero).otherwise(F.col("payamt"))
                         ).withColumn("egresos", F.when(inn, zero).otherwise(F.col("payamt")))


def cash_movements_with_opening(payments, start, end, account=None) -> DataFrame:
    """Opening balance per box and direction, then the completed payments of the range."""
    p = payments.filter(F.col("docstatus").isin("CO", "CL"))
    if account is not None:
        p = p.filter(F.col("c_bankaccount_id") == account)
    p = _signed(p)
    opening = p.filter(F.col("dateacct") < day(start)).groupBy("c_bankaccount_id", "docbasetype").agg(
        F.sum("ingresos").alias("ingresos"), F.sum("egresos").alias("egresos"))
    opening = opening.select(
        "c_bankaccount_id", "docbasetype", F.lit("Saldo Inicial").alias("documentno"),
        day(start).alias("dateacct"), F.date_sub(day(start), 1).cast("timestamp_ntz").alias("created"),
        F.col("ingresos").cast(MON).alias("ingresos"), F.col("egresos").cast(MON).alias("egresos"))
    moves = p.filter(F.col("dateacct").between(day(start), day(end))).select(
        "c_bankaccount_id", "docbasetype", F.col("c_payment_id").cast("string").alias("documentno"),
        "dateacct", F.col("created").cast("timestamp_ntz").alias("created"),
        F.col("ingresos").cast(MON).alias("ingresos"), F.col("egresos").cast(MON).alias("egresos"))
    return opening.unionByName(moves).distinct().withColumn(
        "tipomov", F.when(F.col("docbasetype") == "APP", "Egresos").otherwise("Ingresos"))


def cash_statement(payments, start, end, account=None, hot_rows=None) -> DataFrame:
    """Movements of a box in order of date and creation with the running balance.

    A box may hold very many movements, so the running sum is split by hour when it does.
    """
    mov = written(cash_movements_with_opening(payments, start, end, account), "movements")
    order = [F.col("dateacct"), F.col("created"), F.col("documentno"), F.col("docbasetype")]
    return running_total(mov, ["c_bankaccount_id"], order, {"saldo": F.col("ingresos") - F.col("egresos")},
                         [F.col("dateacct"), F.date_trunc("minute", "created")], hot_rows)


def cash_crosstab(movements, kinds: dict) -> DataFrame:
    """Amount by kind of document and direction. ``kinds``: docbasetype -> label."""
    label = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[F.col("docbasetype")]
    amount = F.col("ingresos") + F.col("egresos")
    return movements.groupBy("c_bankaccount_id", label.alias("tipodoc")).pivot(
        "tipomov", ["Ingresos", "Egresos"]).agg(F.sum(amount))


def payment_review(payments, boxes, start, end, account=None) -> DataFrame:
    """All payments of a box in a range, whatever their status."""
    p = _signed(payments.filter(F.col("dateacct").between(day(start), day(end))))
    if account is not None:
        p = p.filter(F.col("c_bankaccount_id") == account)
    return p.join(boxes.select("c_bankaccount_id", "nombrecaja"), "c_bankaccount_id").select(
        "c_payment_id", "c_bpartner_id", "dateacct", "docbasetype", "c_doctype_id", "c_charge_id",
        "ingresos", "egresos", F.col("nombrecaja").alias("cuenta"), "docstatus")
