"""Values the results depend on.

Fixed values: they are part of the data contract (codes stored in the source
tables, labels written to the result tables, job defaults), so they are kept
literally and in one place.
"""

from datetime import date

# Codes found in the source tables.
ORIGIN_AX = "AX"
RISK_LIFE = "VIDA"
YES = "SI"
COMPANY_01 = "01"
ERP_LEGACY = "ERP_LEGADO"
ERP_NEW = "ERP_NUEVO"
CURRENCY_SOL = "SOL"
CURRENCY_USD = "USD"
RATE_TYPE_MONTHLY = "M"
MANUAL_ENTRIES = "ASIENTOS MANUALES"
PRODUCTION_FLAG = "PRODUCCION"
EXCLUDED_LINE = "AX-ASME"
PARTNER_SUBCHANNEL = "301"
LIFE_RISKS = ("VIDA-AJUSTE", "VIDA")
CLAIMS_WITHOUT_RECOVERY = "SINIESTROS SIN RECUPEROS"
WITHOUT_ADJUSTMENT = "SIN AJUSTE"
LINE_PREFIX = "S"
MISSING_ID = "0"

# Labels written to the premium table.
GROUP_PREMIUM = "Primas"
CONCEPT_DIRECT = "Directo"
COMPONENT = "PRIMAS"
SUB_COMPONENT = "DIRECTO"
DATA_ORIGIN = "DIRECTO"

# Run status and resources in the run ledger.
SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"
RESOURCE_MANAGED_RESULT = "dag_upstream_rt_gerencial"
RESOURCE_FINANCIAL_DATA = "dag_upstream_dato_financiero"

# Order synchronisation states.
PENDING = "PENDING"
PROCESSING = "PROCESSING"
DISPATCHED = "DISPATCHED"

# Defaults.
ERP_CUT_MONTH = date(2024, 4, 1)
RUN_PREFIX = "tmp_oppo"
WINDOW_MONTHS_BACK = 2
PREMIUM_MONTHS_BACK = 11
LEDGER_MAX_AGE_DAYS = 7
LEDGER_FALLBACK_DAYS = 1
SNAPSHOT_SHIFT_HOURS = 5
