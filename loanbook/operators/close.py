"""Month-end regulatory tables.

One as-of aggregate of the collections feeds the loans, balances, ageing and status of a
period; reference lists and route owners are fixed-size dimensions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook import config
from loanbook.functions.dates import maturity
from loanbook.functions.scalars import birthdate, dec, iif
from loanbook.operators.balances import collected, day, with_collected
from loanbook.operators.interest import _elapsed, linear_interest, period_interest
from loanbook.operators.payments import split_principal_first
from loanbook.session import written
from loanbook.sources.sinks import write_period

CALC = "decimal(28,10)"


def active_loans(loans, collections, start, end) -> DataFrame:
    """Loans started by the end that are open, started in the period or last paid in it."""
    w = with_collected(loans.filter(F.col("fecha") <= day(end)), collections, end)
    inside = (F.col("fecha") >= day(start)) | F.col("last_payment").between(day(start), day(end))
    return w.filter((F.col("balance") > 0) | F.coalesce(inside, F.lit(False))).withColumn(
        "fecha_vencimiento", maturity(F.col("fecha"), F.col("dias_cre"), "calendar"))


def with_balances(active, start, end, variant: str = "loop", period_paid=None) -> DataFrame:
    """Accrued interest and the floored balances of principal and interest.

    Variants: 'loop' accrues monto x tasa, 'setbased' accrues by elapsed days,
    'period' reports the interest of the period and keeps the paid share as balance.
    """
    zero = F.lit(0).cast(CALC)
    settled = F.col("balance") <= 0
    days = F.when(settled, F.col("dias_cre")).otherwise(_elapsed(end))
    accrued = {
        "loop": F.when(days != 0, F.col("monto") * F.col("tasa")).otherwise(F.lit(0)),
        "setbased": linear_interest(end),
        "period": period_interest(start, end),
    }[variant].cast(CALC)
    to_principal = (F.col("paid") * (1 - F.col("tasa"))).cast(CALC)
    to_interest = (F.col("paid") * F.col("tasa")).cast(CALC)
    df = active.withColumn("interes_devengado", accrued).withColumn(
        "saldo_principal", F.greatest(zero, F.col("monto").cast(CALC) - to_principal))
    if variant == "period":
        df = df.join(period_paid, "legacy_cartera_id", "left")
        share = F.coalesce(F.col("paid_period"), F.lit(0).cast("decimal(18,2)")) * F.col("tasa") / (
            1 + F.col("tasa"))
        return df.withColumn("saldo_interes", F.greatest(zero, to_interest)).withColumn(
            "interes_corriente", F.greatest(zero, F.col("interes_devengado") - share.cast(CALC)))
    return df.withColumn(
        "saldo_interes", F.greatest(zero, F.col("interes_devengado") - to_interest)
    ).withColumn("interes_corriente", F.col("saldo_interes"))


def ageing(prefix: str, days: Column, amount: Column, bounds: list[int], first_open: bool = True,
           only_if: Column | None = None) -> list[Column]:
    """Bucket columns by day bounds, the last one without upper limit.

    ``first_open``: the first bucket has no lower limit (so buckets of two scales overlap);
    otherwise it starts at 0.
    """
    out, low = [], None
    for high in [*bounds, None]:
        if low is None:
            cond = days <= high if first_open else days.between(0, high)
        elif high is None:
            cond = days > low
        else:
            cond = (days > low) & (days <= high)
        if only_if is not None:
            cond = only_if & cond
        name = f"{prefix}_mas_{low}" if high is None else f"{prefix}_{high:03d}"
        out.append(F.when(cond, amount).otherwise(F.lit(0)).cast(CALC).alias(name))
        low = high
    return out


def ageing_columns(end) -> list[Column]:
    left = F.datediff("fecha_vencimiento", day(end))
    late = F.datediff(day(end), F.col("fecha_vencimiento"))
    return [
        *ageing("mto_intereses_por_vencer", left, F.col("saldo_interes"), config.TO_MATURE_BOUNDS,
                first_open=False, only_if=late > 0),
        *ageing("mto_por_vencer", left, F.col("saldo_principal"), config.TO_MATURE_BOUNDS),
        *ageing("mto_vencido", late, F.col("saldo_principal"), config.OVERDUE_BOUNDS),
    ]


def disjoint_ageing(end) -> list[Column]:
    """The same buckets without overlap: overdue starts after maturity, the rest before."""
    left = F.datediff("fecha_vencimiento", day(end))
    late = F.datediff(day(end), F.col("fecha_vencimiento"))
    return [
        *ageing("por_vencer", left, F.col("saldo_principal"), config.TO_MATURE_BOUNDS, only_if=left >= 0),
        *ageing("vencido", late, F.col("saldo_principal"), config.OVERDUE_BOUNDS, only_if=late > 0),
    ]


def lookup(df, lists, list_name: str, code: str, out: str) -> DataFrame:
    """Description of a code in a reference list, as an integer; null when unknown."""
    one = lists.filter(F.col("lista") == list_name).select(
        F.col("kname").alias(code), F.col("kdesc").cast("int").alias(out))
    return df.join(one, code, "left")


def enriched_partners(partners, groups, route_codes, lists) -> DataFrame:
    """Partners with the codes the regulator asks for."""
    p = partners.join(groups, "rubro", "left").withColumn(
        "id_destino_credito", F.coalesce("grupo_desc", F.lit("7026101")).cast("int"))
    p = p.join(route_codes, "cv_ruta_id", "left")
    for name, code, out in [("riesgo", "tipo_riesgo", "id_clasificacion_credito"),
                            ("zona", "tipo_localizacion", "id_tipo_zona"),
                            ("estadocivil", "civilstatus", "id_estado_civil"),
                            ("genero", "genero", "id_genero")]:
        p = lookup(p, lists, name, code, out)
    return p


def analysts(owners, partners, lists) -> DataFrame:
    """Route owners with national id ('-' if unknown), name and gender code. One row per route."""
    people = partners.select(F.col("c_bpartner_id").alias("owner_id"), "taxid", "nombre", "genero")
    a = owners.join(people, "owner_id", "left")
    return lookup(a, lists, "genero", "genero", "genero_analista").select(
        "cv_ruta_id", F.coalesce("taxid", F.lit("-")).alias("id_analista"),
        F.col("nombre").alias("nombre_analista"), "genero_analista")


# Fixed values of the credit table.
CREDIT_CONSTANTS = {
    "cantidad_prorrogas": 0, "id_tipo_credito": 2, "id_credito_anterior": 0, "id_moneda": 2,
    "id_oficina": 1, "id_origen_recursos": 1, "id_periodo_cobro_interes": 1,
    "id_periodo_cobro_principal": 1, "id_situacion_credito": 1, "id_tipo_agrupacion_credito": 1,
    "id_sector_economico": 4, "id_met_atencion": 1, "id_moneda_linea": 2,
    "cta_contable": "113-01-001", "observaciones": "",
}
CREDIT_ZEROS = [
    "comision_acumulada_por_cobrar", "dias_mora_interes", "dias_mora_principal",
    "mto_adjudicacion_credito", "mto_prorrogado", "mto_saneado", "otras_comisiones_por_cobrar",
    "provision", "tipo_cambio_oficial", "mto_en_mora",
]
CREDIT_NULLS = ["id_garantia", "id_linea", "id_modalidad_credito", "id_sindicado",
                "fecha_ultima_prorroga", "plazo_prorroga", "fecha_estado", "id_credito_grupo"]


def credit_rows(active, collections, people, owners, period_id: int, start, end,
                variant: str = "loop") -> DataFrame:
    """The credit table of a period: one row of 75 columns per active loan."""
    p = people.select("c_bpartner_id", "cv_ruta_id", "id_clasificacion_credito", "id_destino_credito",
                      "id_municipio", "id_tipo_zona")
    joined = active.join(p, "c_bpartner_id").join(owners, "cv_ruta_id", "left")
    return _credit_columns(joined, collections, period_id, start, end, variant)


def _credit_columns(joined, collections, period_id: int, start, end, variant: str) -> DataFrame:
    """The credit table from active loans that already have the columns of their partner and route owner."""
    paid = None
    if variant == "period":
        paid = collected(collections.filter(F.col("operacion") >= day(start)), end).select(
            "legacy_cartera_id", F.col("paid").alias("paid_period"))
    j = with_balances(joined, start, end, variant, paid)
    overdue = F.col("fecha_vencimiento") < day(end)
    total = F.col("saldo_principal") + F.col("saldo_interes")
    settled = total == 0 if variant == "loop" else total <= 0
    payments = F.col("n_positive") if variant == "loop" else F.col("n_payments")
    arrears = F.lit(0) if variant == "loop" else iif(
        overdue, F.col("dias_cre") - F.col("n_payments"), F.lit(0))
    cols = [
        "legacy_cartera_id", F.lit(period_id).alias("c_period_id"),
        payments.cast("bigint").alias("cantidad_cuotas"),
        arrears.cast("bigint").alias("cuotas_vencidas"),
        F.col("fecha").alias("fecha_otorgamiento"),
        F.col("fecha_vencimiento").alias("fecha_vencimiento_credito"),
        "id_clasificacion_credito", F.col("legacy_cartera_id").alias("id_credito"),
        "id_destino_credito", F.col("id_municipio").cast("int").alias("id_municipio"),
        "interes_corriente", iif(overdue, F.col("saldo_interes"), F.lit(0)).cast(CALC).alias("interes_vencidos"),
        F.col("monto").alias("mto_original"), *ageing_columns(end),
        F.col("saldo_principal").alias("saldo"), "tasa",
        F.col("tasa").alias("tasa_costo_efectiva"), F.col("tasa").alias("tasa_contrato"),
        "id_tipo_zona", iif(settled, F.lit(7), F.lit(6)).alias("id_estado_credito"),
        "id_analista",
        *[F.lit(v).alias(k) for k, v in CREDIT_CONSTANTS.items()],
        *[dec("0.00").alias(k) for k in CREDIT_ZEROS],
        *[F.lit(None).cast("string").alias(k) for k in CREDIT_NULLS],
    ]
    return j.select(*cols)


def person_rows(active, people, period_id: int) -> DataFrame:
    """One person row per partner of an active loan."""
    ids = active.select("c_bpartner_id").distinct()
    return _person_columns(people.join(ids, "c_bpartner_id", "left_semi"), period_id)


def _person_columns(people, period_id: int) -> DataFrame:
    return people.select(
        F.lit(period_id).alias("c_period_id"), "c_bpartner_id",
        F.col("birthday").alias("fecha_nacimiento"),
        F.col("id_destino_credito").alias("id_actividad_economica"), "id_estado_civil", "id_genero",
        "id_municipio", F.col("taxid").alias("id_persona"), "nombre",
        F.lit(158).alias("id_pais"), F.lit(0).alias("pep"),
        F.lit(0).alias("id_tipo_persona_juridica"), F.lit(1).alias("id_tipo_persona"),
        F.lit(1).alias("id_tipo_documento"), F.lit(2).alias("id_tipo_grupo"))


def credit_person_rows(active, people, period_id: int) -> DataFrame:
    """Link from each credit to its person."""
    return _credit_person_columns(active.join(people.select("c_bpartner_id", "taxid"), "c_bpartner_id"), period_id)


def _credit_person_columns(joined, period_id: int) -> DataFrame:
    return joined.select(
        F.lit(period_id).alias("c_period_id"),
        F.col("legacy_cartera_id").cast("string").alias("id_credito"),
        F.col("taxid").alias("id_persona"), F.lit(1).alias("id_tipo_documento"),
        F.lit(2).alias("id_moneda"))


def analyst_rows(active, people, owners, period_id: int) -> DataFrame:
    """One analyst row per national id; several routes of one owner collapse into one."""
    used = active.join(people.select("c_bpartner_id", "cv_ruta_id"), "c_bpartner_id").select(
        "cv_ruta_id").distinct()
    return _analyst_columns(used.join(owners, "cv_ruta_id"), period_id)


def _analyst_columns(rows, period_id: int) -> DataFrame:
    return rows.groupBy("id_analista").agg(
        F.min_by(F.struct("nombre_analista", "genero_analista"), "cv_ruta_id").alias("a")).select(
        F.lit(period_id).alias("c_period_id"), "id_analista",
        F.col("a.nombre_analista").alias("nombre"), F.col("a.genero_analista").alias("id_genero"))


def placement_rows(loans, period_id: int, start, end) -> DataFrame:
    """Loans placed in the period: one row of totals."""
    return loans.filter(F.col("fecha").between(day(start), day(end))).agg(
        F.count(F.lit(1)).alias("cantidad_creditos"),
        F.sum("montototal").alias("mto_prestamo_cor"), F.sum("monto").alias("mto_desembolsado_cor"),
    ).select(
        F.lit(period_id).alias("c_period_id"), "cantidad_creditos", "mto_prestamo_cor",
        dec("0.00").alias("mto_prestamos_dol"), "mto_desembolsado_cor",
        dec("0.00").alias("mto_desembolsado_dol"), F.lit(1).alias("id_tipo_fondo"),
        F.lit("").alias("otro_fondo"), F.lit(1).alias("id_forma_entrega"),
        F.lit(2).alias("id_tipo_lugar"))


def recovery_rows(loans, collections, period_id: int, start, end) -> DataFrame:
    """Payments received in the period, principal first: one row of totals."""
    split = split_principal_first(loans, collections, start, end)
    zero = dec("0.00")
    return split.agg(
        F.count(F.lit(1)).alias("cantidad_pagos"),
        F.coalesce(F.sum("abono_principal"), zero).alias("mto_principal_cor"),
        F.coalesce(F.sum("abono_interes"), zero).alias("mto_interes_cor"),
    ).select(
        F.lit(period_id).alias("c_period_id"), "cantidad_pagos", "mto_principal_cor",
        "mto_interes_cor", zero.alias("mto_principal_dol"), zero.alias("mto_interes_dol"),
        F.lit(1).alias("id_forma_pago"), F.lit(2).alias("id_lugar_pago"),
        F.lit(1).alias("id_tipo_cartera"))


def fill_birthdays(partners) -> DataFrame:
    """Missing birthdays taken from the national id."""
    return partners.withColumn("birthday", F.coalesce("birthday", birthdate(F.col("taxid"))))


def close_facts(loans, collections, partners, groups, route_codes, lists, owners, start, end) -> DataFrame:
    """Active loans with their partner (struct ``_p``) and the owner of their route: what four tables of a close are read from."""
    people = enriched_partners(partners, groups, route_codes, lists)
    staff = analysts(owners, partners, lists).withColumn("_owned", F.lit(True))
    own = ["cv_ruta_id", "id_clasificacion_credito", "id_destino_credito", "id_municipio", "id_tipo_zona"]
    more = ["birthday", "id_estado_civil", "id_genero", "taxid", "nombre"]
    people = people.select("c_bpartner_id", *own, F.struct(*[F.col(c) for c in more]).alias("_p"))
    return active_loans(loans, collections, start, end).join(people, "c_bpartner_id").join(staff, "cv_ruta_id", "left")


def close_tables(loans, collections, partners, groups, route_codes, lists, owners,
                 period_id: int, start, end, variant: str = "loop", write_once: bool = False) -> dict[str, DataFrame]:
    """All tables of a period close.

    Four of them are projections, or one aggregate, of the same joined rows (``close_facts``); ``write_once`` writes
    these first, so that each join runs once whatever number of tables is read.
    """
    if not period_id:
        raise ValueError("a period id is required")
    facts = close_facts(loans, collections, partners, groups, route_codes, lists, owners, start, end)
    if write_once:
        facts = written(facts, "close-facts")
    one_person = facts.dropDuplicates(["c_bpartner_id"]).select(
        "c_bpartner_id", "id_destino_credito", "id_municipio", "_p.*")
    staff = facts.filter("_owned").select("cv_ruta_id", "id_analista", "nombre_analista", "genero_analista")
    return {
        "credito": _credit_columns(facts, collections, period_id, start, end, variant),
        "persona": _person_columns(one_person, period_id),
        "credito_persona": _credit_person_columns(facts.withColumn("taxid", F.col("_p.taxid")), period_id),
        "analista": _analyst_columns(staff, period_id),
        "colocaciones": placement_rows(loans, period_id, start, end),
        "recuperaciones": recovery_rows(loans, collections, period_id, start, end),
    }


def period_close(tables: dict[str, DataFrame], target_dir: str, period_id: int) -> None:
    """Write the tables of a close; running it again replaces the same period only, also by nothing."""
    for name, df in tables.items():
        write_period(df, f"{target_dir}/{name}", periods=[period_id])
