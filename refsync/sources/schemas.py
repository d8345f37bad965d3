"""Declared schemas of the tables and records the jobs read.

Column names and types are fixed by the systems on either side.
"""

FACILITY_RECORD = (
    "id string, reference_id string, is_deleted boolean, last_updated string, name string,"
    " code string, acronym string, category string, ownership string, management string,"
    " municipality string, province string, is_operational boolean, latitude string,"
    " longitude string, services array<struct<name: string, code: string>>"
)

FACILITIES = (
    "id string, active boolean, code string, comment string, description string,"
    " enabled boolean, godowndate date, golivedate date, name string,"
    " openlmisaccessible boolean, geographiczoneid string, operatedbyid string, typeid string,"
    " extradata string, location string"
)

GEOGRAPHIC_ZONES = (
    "id string, catchmentpopulation int, code string, latitude decimal(8,5),"
    " longitude decimal(8,5), name string, levelid string, parentid string, boundary string,"
    " extradata string"
)

GEOGRAPHIC_LEVELS = "id string, code string, levelnumber int, name string"

FACILITY_TYPES = (
    "id string, active boolean, code string, description string, displayorder int, name string,"
    " primaryhealthcare boolean"
)

FACILITY_OPERATORS = (
    "id string, code string, description string, displayorder int, name string"
)

PROGRAMS = (
    "id string, active boolean, code string, description string, name string,"
    " periodsskippable boolean, shownonfullsupplytab boolean,"
    " enabledatephysicalstockcountcompleted boolean, skipauthorization boolean"
)

SUPPORTED_PROGRAMS = (
    "active boolean, startdate date, facilityid string, programid string,"
    " locallyfulfilled boolean"
)

DATA_CHANGES = (
    "id bigint, schema_name string, table_name string, operation string,"
    " change_time timestamp, row_data string"
)

SYNC_LOGS = (
    "id string, resource string, sync_type string, operation string, timestamp timestamp,"
    " success boolean, message string, details string"
)

PROGRAM_SUPPORT = (
    "struct<id: string, supportActive: boolean, supportLocallyFulfilled: boolean,"
    " supportStartDate: string>"
)

PROGRAM_MAP = f"map<string, {PROGRAM_SUPPORT}>"

ENVELOPE_COLUMNS = ("id", "schema_name", "table_name", "operation", "change_time", "row_data")
