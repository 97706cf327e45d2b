"""Column names, state vocabulary and per-level specifications.

Every operator in the package is generic over (keys, state column, timestamp
column, tie-breaker).  ``PARENT`` and ``CHILD`` instantiate them for the two
levels of the case log.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# --- Fixed values: these strings must equal the ones found in the case log.
ASSIGNED = "Asignado"
SUPPRESSED = "Folio suprimido"
REJECTED = ("SIN Prestador", "Rechazo paciente sin consulta", "No acepta tratamiento")
NOT_ACCEPTED = (ASSIGNED, SUPPRESSED) + REJECTED
CODED_URL_MARK = "codificado"
GRD_CLASS = "GRD"
CURRENT = "current"
LEGACY = "legacy"
CODE_WIDTH = 6
CODE_SEPARATOR = ":"
TENANT = "cliente"
PARENT_KEY = "folio_padre"
CHILD_KEY = "folio_hijo"
TS = "fecha_registro"
TIE = "load_seq"

RAW_COLUMNS = (
    "cliente", "folio_padre", "folio_hijo", "fecha_registro", "estado_padre",
    "estado_hijo", "ppa_grd", "monto_total", "fecha_asignacion", "rut_paciente",
    "nombre_paciente", "intervencion_sanitaria", "url_ficha", "load_seq",
)
DETAIL_COLUMNS = ("url_ficha", "fecha_atencion", "intervencion_sanitaria_ingreso", "problema_salud")
BENEFIT_COLUMNS = ("cliente", "folio", "descripcion", "estado")

PARENT_STATIC = (
    "cliente", "folio_padre", "fecha_asignacion", "rut_paciente",
    "nombre_paciente", "intervencion_sanitaria", "url_ficha",
)
CHILD_BASE = (
    "cliente", "folio_padre", "folio_hijo", "intervencion_sanitaria",
    "ppa_grd", "monto_total", "url_ficha",
)
PARENT_DIM = PARENT_STATIC + (
    "tipo_seguimiento", "fecha_asignacion_aceptada", "fecha_atencion",
    "intervencion_sanitaria_ingreso", "problema_salud",
    "ultimo_estado_folio_padre", "fecha_ultimo_estado_folio_padre",
)
CHILD_DIM = CHILD_BASE + (
    "descripcion", "estado_prestacion", "tipo_seguimiento",
    "ultimo_estado_folio_hijo", "fecha_ultimo_estado_folio_hijo",
    "primer_estado_folio_hijo", "fecha_primer_estado_folio_hijo", "grd",
)
# --- end of fixed values


#: Partition column of a log or history that is stored by day.
DAY = "dia"


@dataclass(frozen=True)
class Level:
    """One level of the case hierarchy.

    ``keys`` identify a case in the history; ``columns`` are the history
    table's columns (without the tie-breaker, which the store keeps as well);
    ``dim_keys`` identify a row of the dimension; ``blank_key`` is a key that
    must be non-blank for a raw row to belong to this level.
    """

    name: str
    keys: tuple[str, ...]
    state: str
    columns: tuple[str, ...]
    dim_keys: tuple[str, ...]
    blank_key: str | None = None
    context: tuple[str, ...] = ()


PARENT = Level(
    name="parent",
    keys=(TENANT, PARENT_KEY),
    state="estado_padre",
    columns=(TENANT, PARENT_KEY, TS, "estado_padre"),
    dim_keys=(TENANT, PARENT_KEY),
)

CHILD = Level(
    name="child",
    keys=(TENANT, CHILD_KEY),
    state="estado_hijo",
    columns=(TENANT, PARENT_KEY, CHILD_KEY, "ppa_grd", TS, "estado_padre", "estado_hijo"),
    dim_keys=(TENANT, PARENT_KEY, CHILD_KEY),
    blank_key=CHILD_KEY,
    context=(PARENT_KEY, "ppa_grd", "estado_padre"),
)


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, cols, what: str = "input") -> DataFrame:
    """Raise if ``df`` lacks any of ``cols``; return ``df`` for chaining."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"{what} lacks required columns {missing}; has {df.columns}")
    return df
