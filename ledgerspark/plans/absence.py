"""Employee master and the monthly count of open absences."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.pick import latest_link
from ledgerspark.schemas import schema_of
from ledgerspark.sources.publish import publish_version
from ledgerspark.sources.tables import not_deleted

# Fixed: the names readers of the calendar know.
SHOWN_AS = {"cue_nombre": "Cuenta", "sar_nombre": "Sub_Cuenta", "srv_nombre": "Servicio", "car_nombre": "Cargo"}
# Tables have a soft-delete flag, but for these.
UNFLAGGED = {"empleado"}
ERP_LINK_FLAG = "eis_anulado"


def source(name: str, table: DataFrame) -> DataFrame:
    """Live rows of a source table, with the columns and types of its schema."""
    if name not in UNFLAGGED:
        table = not_deleted(table, ERP_LINK_FLAG if name == "empleado_erp" else "anulado")
    return table.select(*[F.col(f.name).cast(f.dataType) for f in schema_of(name)])


def employee_master(tables: dict[str, DataFrame]) -> DataFrame:
    """Employees with an open ERP link, with account, sub-account, service and post.

    ``tables`` holds the raw source tables by name. An employee has one row per
    open ERP link. Account and service are those of the latest link; equal dates
    are decided by the other columns.
    """
    def named(links: DataFrame, *dimensions: tuple[str, str]) -> DataFrame:
        """One link per employee, with the names of what it points to."""
        for name, key in dimensions:
            links = links.join(source(name, tables[name]), key, "left")
        return links

    account_links = source("empleado_cuenta", tables["empleado_cuenta"])
    newest_account = latest_link(
        account_links, "emp_id", "ecu_fechadesde", "ecu_fechahasta", "cue_id", "car_id", "sar_id"
    )
    accounts = named(newest_account, ("cuenta", "cue_id"), ("subarea", "sar_id"), ("cargo", "car_id")).select(
        "emp_id", "cue_nombre", "sar_nombre", "car_nombre")
    service_links = source("empleado_servicio", tables["empleado_servicio"])
    newest_service = latest_link(service_links, "emp_id", "empsrv_fechadesde", "srv_id")
    services = named(newest_service, ("servicios", "srv_id")).select("emp_id", "srv_nombre")

    still_open = F.col("eis_fechaHasta").isNull() & F.col("id_personal_erp").isNotNull()
    erp_ids = source("empleado_erp", tables["empleado_erp"]).where(still_open).select("emp_id", "id_personal_erp")
    people = source("empleado", tables["empleado"]).join(erp_ids, "emp_id")
    full_name = F.concat_ws(" ", "emp_apellido", "emp_nombre")
    return people.join(accounts, "emp_id", "left").join(services, "emp_id", "left").select(
        "id_personal_erp", "emp_id", full_name.alias("nombre_completo"), "emp_num_documento",
        *[F.col(c).alias(shown) for c, shown in SHOWN_AS.items()],
    )


def open_absences(absences: DataFrame, as_of: date) -> DataFrame:
    """Absences of the year of ``as_of`` not yet controlled, counted by employee and month."""
    first, next_first = date(as_of.year, 1, 1), date(as_of.year + 1, 1, 1)
    started = F.col("aus_fechadesde")
    # The year as a range on the column itself, which reaches the scan.
    return (
        source("ausentismo", absences.where(
            (started >= F.lit(first)) & (started < F.lit(next_first))
            & F.col("aus_fechacontrol").isNull()
        ))
        .groupBy("emp_id", F.year(started).alias("Anio"), F.month(started).alias("Mes"))
        .agg(F.count(F.lit(1)).alias("cuenta_ausentismo"))
    )


def absence_calendar(master: DataFrame, absences: DataFrame) -> DataFrame:
    """Open absences per month of the employees in ``master``, with their master data.

    Employees without open absences and absences of employees outside the master
    do not appear: the master's own ERP id has to be present.
    """
    return master.join(absences, "emp_id", "inner")


def run_absence(tables: dict[str, DataFrame], as_of: date, target: str) -> DataFrame:
    """The absence job: master data, open absences of the year and the wide table, published under ``target``.

    Each is published whole, so a run that fails leaves the former tables; the wide table is
    made from what was published and comes back.
    """
    master = publish_version(employee_master(tables), f"{target}/maestro")
    counts = publish_version(open_absences(tables["ausentismo"], as_of), f"{target}/ausentismo", ["Anio"])
    return publish_version(absence_calendar(master, counts), f"{target}/cronograma", ["Anio"])
