"""Bulk migration of legacy tables and files, and master data."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.functions.scalars import clean_id
from loanbook.operators.balances import day, with_collected
from loanbook.operators.ordered import number_rows
from loanbook.operators.tries import Blocks
from loanbook.session import written

# Fixed value: first id when the target table is empty.
FIRST_ID = 10_000_000


def next_start(target, column: str) -> Column:
    """Highest id in use, as a scalar subquery."""
    return F.coalesce(target.select(F.max(column)).scalar(), F.lit(FIRST_ID))


def new_rows(source, target, keys: list[str], id_name: str) -> DataFrame:
    """Source rows whose key is not in the target, numbered by key after the target's highest id.

    Keys compare null-safe, so a row with a null in its key is new once and known afterwards.
    """
    known = target.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return number_rows(source.join(known, same, "left_anti"), keys, id_name, next_start(target, id_name))


def migrate_collections(source, target) -> dict[str, DataFrame]:
    """New collections get the next ids; known ones take the source amount and origin."""
    keys = ["id_cobro", "ad_org_id"]
    positive = source.filter(F.col("abono") > 0)
    known = target.select("legacy_cobro_id", *keys).join(
        positive.select(*keys, "abono"), keys).withColumn("origen", F.lit("migrated"))
    fresh = new_rows(positive, target, keys, "legacy_cobro_id").withColumn(
        "origen", F.lit("migrated")).withColumn("synced", F.lit("N"))
    return {"inserts": fresh, "updates": known}


def migrate_loans(source, target) -> DataFrame:
    return new_rows(source, target, ["id_cartera", "ad_org_id"], "legacy_cartera_id").withColumn(
        "origen", F.lit("migrated")).withColumn("aprobado", F.lit("Y"))


def migrate_partners(source, activities, target) -> DataFrame:
    """New legacy clients with the name of their activity."""
    named = source.join(activities, "id_actividad", "left")
    return new_rows(named, target, ["id_cliente", "ad_org_id"], "legacy_cliente_id").withColumn(
        "origen", F.lit("migrated"))


def migrate_territories(source, target) -> DataFrame:
    return new_rows(source, target, ["id_territorio", "ad_org_id"],
                    "legacy_territorio_id").withColumn("origen", F.lit("migrated"))


def opening_loans(balances, matched, partners, migrated) -> dict[str, DataFrame]:
    """Opening balances to loans.

    ``balances``: row_id, tarjeta, fecha, monto, montototal, saldo, vencimiento, corrupt.
    ``matched``: row_id, c_bpartner_id (null when no partner was found). Corrupt rows, rows
    without a partner, or whose partner already has a migrated loan, are rejected; of several rows for
    one partner the first counts.
    """
    # Lines are parsed once, for the first of each partner and for the rows.
    j = written(balances.join(matched.select("row_id", "c_bpartner_id"), "row_id", "left"), "opening")
    taken = migrated.select("c_bpartner_id").distinct().withColumn("_taken", F.lit(True))
    first = j.filter(F.col("c_bpartner_id").isNotNull() & F.col("corrupt").isNull()).groupBy("c_bpartner_id").agg(
        F.min("row_id").alias("_first"))
    j = j.join(taken, "c_bpartner_id", "left").join(first, "c_bpartner_id", "left")
    reason = F.when(F.col("corrupt").isNotNull(), "linea no valida").when(
        F.col("c_bpartner_id").isNull(), "tercero no encontrado").when(
        F.col("_taken") | (F.col("row_id") != F.col("_first")), "tercero con prestamo migrado")
    j = j.withColumn("motivo", reason)
    interest = F.col("montototal") - F.col("monto")
    good = j.filter(F.col("motivo").isNull()).join(
        partners.select("c_bpartner_id", F.col("ad_org_trx_id").alias("ad_org_id")), "c_bpartner_id")
    return {
        "loans": good.select(
            "row_id", "c_bpartner_id", "ad_org_id", "fecha",
            F.concat(F.lit("Migrado from tarjeta: "), F.col("tarjeta")).alias("concepto"),
            F.greatest(F.lit(30), F.datediff("vencimiento", "fecha")).alias("dias_cre"),
            F.round(F.col("montototal") / F.lit("30").cast("decimal(2,0)"), 2).cast("decimal(18,2)").alias("cuota"),
            "monto", interest.cast("decimal(18,2)").alias("valorinteres"), "montototal",
            (F.col("montototal") - F.col("saldo")).cast("decimal(18,2)").alias("abono"), "saldo",
            F.round(interest / F.col("monto"), 2).cast("decimal(10,2)").alias("tasa"),
            F.lit("N").alias("synced"), F.lit("migrado").alias("origen"), F.lit("Y").alias("aprobado")),
        "rejects": j.filter(F.col("motivo").isNotNull()).select("row_id", "c_bpartner_id", "motivo"),
    }


def _deletions(name: Column, most: int) -> Column:
    """The name and every string left after removing up to ``most`` characters."""
    out = level = F.array(name)
    for _ in range(most):
        # sequence(1, 0) counts down, so empty strings are left out.
        level = F.array_distinct(F.flatten(F.transform(
            F.filter(level, lambda s: F.length(s) > 0),
            lambda s: F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(
                F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s)))))))
        out = F.array_union(out, level)
    return out


def _within(name: str, lengths: list[int], most: int) -> Column:
    """Whether the length of a name is within ``most`` of one of these."""
    near = sorted({x + by for x in lengths for by in range(-most, most + 1)})
    return F.array_contains(F.array(*[F.lit(x) for x in near]).cast("array<int>"), F.length(name))


def _lengths(names, name: str) -> list[int]:
    return [r[0] for r in names.select(F.length(name)).distinct().collect()]  # one for each length of a name


def nearest_partner(rows, partners, near: int = 2) -> DataFrame:
    """Partner with the smallest edit distance on the name. Ties go to the lowest partner id.

    Two names within ``near`` edits share a string after removing as many characters from
    each, so they meet in an equi join on the hash of those strings, one distance after the other; only names whose lengths
    allow that distance make such strings. Names that are farther from every partner are searched in blocks of partners
    (``tries.Blocks``), of which each meets few. Every row gets a partner unless there is none or its name is null.
    ``rows``: row_id, name.
    """
    # Few bytes make very many pieces: names are spread by number.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = written(partners.filter(F.col("nombre").isNotNull()).groupBy(F.col("nombre").alias("bp_name")).agg(
        F.min("c_bpartner_id").alias("c_bpartner_id")), "partners")
    lengths = _lengths(base, "bp_name")
    names = written(rows.select("name").filter(F.col("name").isNotNull()).distinct(), "names")
    same = names.join(base, names.name == base.bp_name).select(
        "name", "c_bpartner_id", F.lit(0).alias("distancia"))
    found, rest = same, written(names.join(base, names.name == base.bp_name, "left_anti"), "rest")
    # What is settled near needs no wider search.
    for most in range(1, near + 1):
        left = rest.filter(_within("name", lengths, most)).repartition(parts, "name").select(
            "name", F.explode(_deletions(F.col("name"), most)).alias("_piece"))
        right = base.filter(_within("bp_name", _lengths(rest, "name"), most)).repartition(parts, "bp_name").select(
            "bp_name", "c_bpartner_id", F.explode(_deletions(F.col("bp_name"), most)).alias("_piece"))
        left, right = (x.withColumn("_piece", F.xxhash64("_piece")) for x in (left, right))
        # Spark takes the pieces for as few as the names and would broadcast them: they are dealt out by piece.
        close = left.join(right.hint("merge"), "_piece").select(
            "name", "c_bpartner_id", F.expr(f"levenshtein(name, bp_name, {most})").alias("distancia")).filter(F.col("distancia") >= 0)
        best = written(close.groupBy("name").agg(F.min(F.struct("distancia", "c_bpartner_id")).alias("b")).select(
            "name", F.col("b.c_bpartner_id").alias("c_bpartner_id"), F.col("b.distancia").alias("distancia")), "near")
        rest = written(rest.join(best.select("name"), "name", "left_anti"), "rest")
        found = found.unionByName(best)
    found = found.unionByName(_far(rest, base))
    return rows.join(found, "name", "left").select("row_id", "name", "c_bpartner_id", "distancia")


def _far(names, base) -> DataFrame:
    """(name, c_bpartner_id, distancia) of distinct names, none of which is a partner's."""
    blocks = Blocks(base.select(F.col("c_bpartner_id").alias("ident"), F.col("bp_name").alias("member")))
    return blocks.nearest(names).select("name", F.col("ident").alias("c_bpartner_id"), F.col("distance").alias("distancia"))


def opening_payments(loans, collections, record_date, origin: str = "migrated") -> DataFrame:
    """One synthetic collection per open migrated loan, with what was paid before."""
    w = with_collected(loans.filter(F.col("origen") == origin), collections).filter(F.col("balance") > 0)
    return w.select(F.col("legacy_cartera_id").alias("id_cartera"), "c_bpartner_id", "ad_org_id",
                    F.col("paid").alias("abono"), "cuota", day(record_date).alias("operacion"),
                    F.lit("Y").alias("synced"), F.lit("migrado").alias("origen"),
                    F.lit("valido").alias("cobrostatus"))


def match_partners(clients, partners, routes) -> DataFrame:
    """Legacy clients matched by national id, else by branch code; the rest are created.

    ``clients``: legacy_cliente_id, cedula, org_key, codigo, ad_org_id, id_vendedor.
    ``routes``: ad_org_id, id_territorio, cv_ruta_id.
    """
    by_id = partners.filter(F.col("taxid").isNotNull()).groupBy(F.col("taxid").alias("cedula")).agg(
        F.min("c_bpartner_id").alias("_by_id"))
    by_code = partners.groupBy(F.col("codigo").alias("_code")).agg(F.min("c_bpartner_id").alias("_by_code"))
    c = clients.withColumn("_code", F.concat_ws("-", "org_key", "codigo"))
    j = c.join(by_id, "cedula", "left").join(by_code, "_code", "left").join(
        routes.withColumnRenamed("id_territorio", "id_vendedor"), ["ad_org_id", "id_vendedor"], "left")
    found = F.coalesce("_by_id", F.col("_by_code"))
    return j.select(
        "legacy_cliente_id", "cedula", F.col("_code").alias("codigo"), "cv_ruta_id",
        found.alias("c_bpartner_id"),
        F.when(F.col("cv_ruta_id").isNull(), "ruta no valida").when(F.col("_by_id").isNotNull(), "por cedula")
        .when(F.col("_by_code").isNotNull(), "por codigo").otherwise("crear").alias("accion"))


def partners_from_csv(rows, partners, routes, cities) -> dict[str, DataFrame]:
    """New partners of a file with branch and city of their route; known ids are rejected.

    ``rows``: row_id and the fields of sources.readers.parse_partners. Of several rows with
    one id the first is taken.
    """
    known = partners.filter(F.col("taxid").isNotNull()).select(F.col("taxid").alias("cedula")).distinct().withColumn(
        "_known", F.lit(True))
    first = rows.groupBy("cedula").agg(F.min("row_id").alias("_first"))
    j = rows.join(known, "cedula", "left").join(first, "cedula", "left").join(
        routes, "cv_ruta_id", "left").join(cities, "ad_org_trx_id", "left")
    reason = (
        F.when(F.col("corrupt").isNotNull(), "fila no valida")
        .when(F.col("ad_org_trx_id").isNull(), "ruta no encontrada")
        .when(F.col("c_city_id").isNull(), "ciudad no encontrada")
        .when(F.col("_known") | (F.col("row_id") != F.col("_first")), "cedula ya registrada"))
    j = j.withColumn("motivo", reason)
    return {
        "partners": j.filter(F.col("motivo").isNull()).select(
            "row_id", "cedula", "nombre", "direccion", "telefono", "cv_ruta_id", "c_bp_group_id",
            "ad_org_trx_id", "c_city_id"),
        "rejects": j.filter(F.col("motivo").isNotNull()).select("row_id", "cedula", "motivo"),
    }


def territories_to_routes(territories, routes) -> dict[str, DataFrame]:
    """Territories to routes by (territory, branch): existing ones are linked, others created."""
    keys = ["id_territorio", "ad_org_id"]
    known = routes.select(*keys, F.col("cv_ruta_id"))
    j = territories.join(known, keys, "left")
    return {"linked": j.filter(F.col("cv_ruta_id").isNotNull()).select(*keys, "cv_ruta_id"),
            "created": j.filter(F.col("cv_ruta_id").isNull()).select(
                *keys, F.col("zona").alias("name"), F.col("codigo").alias("description"))}


def approve_applications(applications, partners, branches, cities) -> dict[str, DataFrame]:
    """Customer applications to partners with a location; the others with a reason.

    The national id is compared as typed with the stored ids, and stored without blanks and
    dashes. Within the batch the first application of a cleaned id wins.
    """
    a = applications.withColumn("taxid", clean_id(F.col("cedula")))
    known = partners.filter(F.col("taxid").isNotNull()).select(F.col("taxid").alias("cedula")).distinct().withColumn(
        "_known", F.lit(True))
    first = a.filter(~F.col("synced").eqNullSafe(F.lit("Y"))).groupBy("taxid").agg(
        F.min("solicitud_id").alias("_first"))
    j = (
        a.join(known, "cedula", "left").join(first, "taxid", "left")
        .join(branches.select("ad_org_id", F.lit(True).alias("_org")), "ad_org_id", "left")
        .join(cities.select(F.col("ad_org_trx_id").alias("ad_org_id"), "c_city_id", "city"), "ad_org_id", "left"))
    reason = (
        F.when(F.col("_org").isNull(), "organizacion no valida")
        .when(F.col("c_city_id").isNull(), "sin ciudad")
        .when(F.col("_known"), "cedula ya registrada")
        .when(F.col("synced") == "Y", "ya procesada")
        .when(F.col("solicitud_id") != F.col("_first"), "cedula repetida"))
    j = j.withColumn("motivo", reason)
    good = j.filter(F.col("motivo").isNull())
    return {
        "partners": good.select("solicitud_id", "nombre", "taxid", F.col("ad_org_id").alias("ad_org_trx_id"),
                                F.col("idruta").alias("cv_ruta_id"), F.col("idrubro").alias("c_bp_group_id"),
                                F.col("monto").alias("so_creditlimit"), "genero", "tipo_localizacion"),
        "locations": good.select("solicitud_id", "c_city_id", F.col("city").alias("name"),
                                 F.col("direccion").alias("address1"), F.col("telefono").alias("phone")),
        "updates": good.select("solicitud_id", F.lit("Y").alias("synced")),
        "rejects": j.filter(F.col("motivo").isNotNull()).select("solicitud_id", "motivo"),
    }


def missing_locations(partners, locations, cities) -> DataFrame:
    """A location from the quick address for partners that have none."""
    p = partners.filter(F.length("quickaddress") > 0).join(
        locations.select("c_bpartner_id").distinct(), "c_bpartner_id", "left_anti")
    return p.join(cities, "ad_org_trx_id").select(
        "c_bpartner_id", "c_city_id", F.col("city").alias("name"),
        F.col("quickaddress").alias("address1"), F.col("quickphone").alias("phone"))


def clone_rows(children, parent_column: str, seed, target) -> DataFrame:
    """The children of a seed parent copied to a target parent."""
    return children.filter(F.col(parent_column) == seed).withColumn(parent_column, F.lit(target))
