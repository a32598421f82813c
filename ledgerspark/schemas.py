"""Columns of the source tables, as DDL; ``read_table`` checks a table against its schema."""

from __future__ import annotations

from pyspark.sql.types import StructType

from ledgerspark.plans.dims import CHANNEL_COLUMNS, GROUPINGS, POLICY_COLUMNS


def _strings(columns: list[str]) -> str:
    return ", ".join(f"{c} string" for c in columns)


def _elements(columns: list[str]) -> str:
    return f"array<struct<{', '.join(f'{c}:string' for c in columns)}>>"


def _policy_type(column: str) -> str:
    return "date" if column == "periodo" or column.startswith("fec_") else "string"


SOURCES = {
    "producto": f"""id_producto string, nom_producto string,
        producto_origen {_elements(['id_origen', 'cod_producto'])},
        producto_jerarquia {_elements(['nom_riesgo', *GROUPINGS, 'id_ramo_contable'])},
        arr_equivalencia_contable {_elements([
            'id_companhia', 'id_origen', 'cod_producto_contable',
            'ind_contable_principal', 'ind_tecnico_principal'])}""",
    "ramo": f"""{_strings(['id_ramo', 'des_ramo', 'id_ramo_contable', 'des_ramo_contable'])},
        arr_equivalencia_contable {_elements([
            'cod_ramo_contable', 'des_ramo_erp', 'des_ramo_contable', 'id_companhia',
            'ind_tecnico_principal', 'ind_contable_principal'])}""",
    "poliza": ", ".join(f"{c} {_policy_type(c)}" for c in POLICY_COLUMNS),
    "bitacora_mc_poliza": "dsc_periodo string, id_poliza string, id_equivalencia_canal long",
    "equivalencia_canal": _strings(["id_equivalencia_canal", *CHANNEL_COLUMNS]),
    "tasa_cambio": """fec_tasa date, id_moneda_origen string, id_moneda_fin string,
        tip_tasa_cambio string, val_tasa_cambio decimal(18,6)""",
    "produccion": """periodo date, fec_procesamiento date, ram_id_ramo_tecnico string,
        id_producto string, cod_producto_origen string, pol_id_poliza string,
        cer_id_certificado string, tip_registro_primas string, pol_id_moneda_origen string,
        ind_acumulado string, tc_a_sol decimal(18,6), mnt_prima_np_usd decimal(18,2),
        mnt_derecho_emision_usd decimal(18,2)""",
    # Fixed: data contract of the personnel tables, as their owner defines them.
    "empleado": "emp_id int, emp_apellido string, emp_nombre string, emp_num_documento int",
    "empleado_cuenta": """emp_id int, cue_id int, car_id int, ecu_fechadesde timestamp,
        ecu_fechahasta timestamp, sar_id int""",
    "cuenta": "cue_id int, cue_nombre string",
    "subarea": "sar_id int, sar_nombre string",
    "empleado_erp": "emp_id int, id_personal_erp int, eis_fechaHasta timestamp",
    "empleado_servicio": "emp_id int, srv_id int, empsrv_fechadesde timestamp",
    "servicios": "srv_id int, srv_nombre string",
    "cargo": "car_id int, car_nombre string",
    "ausentismo": "emp_id int, aus_fechadesde timestamp, aus_fechacontrol timestamp",
}


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(SOURCES[table])
