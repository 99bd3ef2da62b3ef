"""Record, version and publication schemas, declared once.

Column lists elsewhere are derived from these, so adding a field is one edit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: record fields, in publication order ----------------------
TEXT_FIELDS_REQUIRED = (
    "id_hash", "id_url", "url", "title", "description", "checksum", "license_info",
)
TEXT_FIELDS_OPTIONAL = (
    "more_info", "legal_basis",
    "contact_info_institution", "contact_info_street", "contact_info_city",
    "contact_info_fax", "contact_info_phone", "contact_info_email",
    "contact_info_website", "funding_body",
)
LIST_FIELDS = (
    "funding_type", "funding_area", "funding_location", "eligible_applicants",
    "further_links",
)
RECORD_FIELDS = (
    "id_hash", "id_url", "url", "title", "description", "more_info", "legal_basis",
    "contact_info_institution", "contact_info_street", "contact_info_city",
    "contact_info_fax", "contact_info_phone", "contact_info_email",
    "contact_info_website", "funding_type", "funding_area", "funding_location",
    "eligible_applicants", "funding_body", "further_links", "checksum", "license_info",
)
MIN_FIELDS = (
    "id_hash", "deleted", "on_website_from", "url", "title", "description",
    "more_info", "legal_basis", "funding_type", "funding_area", "funding_location",
    "eligible_applicants", "funding_body",
)
MARKDOWN_FIELDS = ("description", "more_info", "legal_basis")
# Left out of the content checksum: what names the record, not what it says.
IDENTITY_FIELDS = ("id_hash", "id_url", "url")
# ----------------------------------------------------------------------------

WATCHED_FIELDS = tuple(
    f for f in RECORD_FIELDS
    if f not in IDENTITY_FIELDS and f not in ("checksum", "license_info")
)

PROGRAM_SCHEMA = T.StructType([
    T.StructField(
        f,
        T.ArrayType(T.StringType()) if f in LIST_FIELDS else T.StringType(),
        f not in TEXT_FIELDS_REQUIRED,
    )
    for f in RECORD_FIELDS
])


@dataclass(frozen=True)
class VersionColumns:
    """Names of the bookkeeping columns of a version table."""

    key: str = "id_hash"
    valid_from: str = "on_website_from"
    valid_to: str = "on_website_to"
    checksum: str = "checksum"
    load: str = "load_id"

    def payload(self, columns) -> list[str]:
        """Record columns: everything that is neither key nor bookkeeping."""
        own = {self.key, self.valid_from, self.valid_to, self.load}
        return [c for c in columns if c not in own]


VERSION_COLUMNS = VersionColumns()

VERSION_SCHEMA = T.StructType(
    list(PROGRAM_SCHEMA.fields)
    + [
        T.StructField("on_website_from", T.TimestampNTZType(), False),
        T.StructField("on_website_to", T.TimestampNTZType(), True),
        T.StructField("load_id", T.LongType(), False),
    ]
)

# fixed values: text delivered with each record and with the whole data set
LICENSE_LINE = (
    "\n{title} von Bundesministerium für Wirtschaft und Klimaschutz, lizensiert unter "
    "CC BY-ND 3.0 DE (https://creativecommons.org/licenses/by-nd/3.0/de/deed.de), "
    "zuletzt abgerufen am {date} unter {url}\n"
)
LICENSE_TEXT = (
    "\nInhalte von foerderdatenbank.de sind individuell lizensiert durch das "
    "Bundesministerium für Wirtschaft und Klimaschutz unter CC BY-ND 3.0 DE. \n"
    "Der hier zur Verfügung gestellte Datensatz gibt die Informationen zu jedem einzelnen "
    "Förderprogramms in einem maschinenlesbaren Format wider. \n"
    "Lizenzinformationen zu jedem einzenlnen Förderprogramm inkl. URL können der "
    "Datensatz-Spalte license_info sowie der Datei LICENSE-DATA entnommen werden.\n"
)
