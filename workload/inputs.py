"""Input tables in the shapes the operators expect, derived from the test tables.

Each is one portable SELECT, read by Spark as the input of a query and by the
checking SQL as a common table expression, so both start from the same rows.
They cover whole tables; arithmetic on keys only varies the values.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
)

INPUTS: dict[str, str] = {}

# --- reference tables of the facility import ---------------------------------

INPUTS["in_levels"] = """
select 'L1' as id, 'country' as name, 1 as levelnumber
union all select 'L2', 'province', 2
union all select 'L3', 'municipality', 3
union all select 'L4', 'ward', 4
"""

# One region and some nations are unknown, so that zones are missing.
INPUTS["in_zones"] = """
select 'Z0' as id, 'COUNTRY' as name, 'L1' as levelid, cast(null as string) as parentid
union all select 'P' || cast(r_regionkey as string), r_name, 'L2', 'Z0'
from region where r_name <> 'MIDDLE EAST'
union all select 'M' || cast(n_nationkey as string), n_name, 'L3',
       'P' || cast(n_regionkey as string)
from nation where n_name not like '%5'
union all select 'W' || cast(n_nationkey as string), 'WARD ' || n_name, 'L4',
       'M' || cast(n_nationkey as string)
from nation where n_name not like '%5'
"""

INPUTS["in_types"] = """
select 'T-' || c_mktsegment as id, c_mktsegment as name, lower(c_mktsegment) as code,
       cast(max(length(c_mktsegment)) as int) as displayorder
from customer where c_mktsegment <> 'MACHINERY' group by c_mktsegment
"""

INPUTS["in_operators"] = """
select 'op-' || cast(s_suppkey as string) as id, s_name as name,
       'S' || cast(s_suppkey as string) as code, cast(s_suppkey as int) as displayorder
from supplier
"""

INPUTS["in_programs"] = """
select distinct 'prog-' || substr(o_orderpriority, 1, 1) as id, o_orderpriority as code,
       'Servico ' || o_orderpriority as name
from orders where o_orderpriority <> '5-LOW'
"""

# Customers with a high balance are not registered yet.
INPUTS["in_facilities"] = """
select 'fac-' || cast(c_custkey as string) as id, 'F' || cast(c_custkey as string) as code,
       c_name as name,
       case when c_custkey % 31 = 0 then null else c_acctbal >= 0 end as active,
       c_custkey % 37 <> 0 as enabled,
       'W' || cast(case when c_custkey % 17 = 0 then 1 else c_nationkey end as string)
           as geographiczoneid,
       case when c_custkey % 11 = 0 then 'T-BUILDING' else 'T-' || c_mktsegment end as typeid,
       'op-' || cast(c_nationkey as string) as operatedbyid
from customer where c_acctbal < 7000
"""

# Low priority orders belong to a program that the program table lacks.
INPUTS["in_supported"] = """
select distinct 'fac-' || cast(o_custkey as string) as facilityid,
       'prog-' || substr(o_orderpriority, 1, 1) as programid,
       true as active, false as locallyfulfilled, cast('2024-01-31' as date) as startdate
from orders where o_orderstatus <> 'O'
"""

# --- incoming records ---------------------------------------------------------

INPUTS["in_services"] = """
select distinct 'F' || cast(o_custkey as string) as facility_code,
       o_orderpriority as code, 'Servico ' || o_orderpriority as name
from orders
"""

INPUTS["in_records"] = """
select 'src-' || cast(c_custkey as string) as id,
       case when c_custkey % 19 = 0 then true when c_custkey % 23 = 0 then null else false end
           as is_deleted,
       case when c_custkey % 41 = 0 then '' when c_custkey % 43 = 0 then null
            when c_custkey % 5 = 0 then c_name || ' Renovado' else c_name end as name,
       case when c_custkey % 47 = 0 then null else 'F' || cast(c_custkey as string) end as code,
       c_mktsegment as category,
       case when c_custkey % 53 = 0 then null else n_name end as municipality,
       case when c_custkey % 59 = 0 then '' else r_name end as province,
       case when c_custkey % 29 = 0 then null when c_custkey % 13 = 0 then false
            else c_acctbal >= 0 end as is_operational,
       case when c_custkey % 7 = 0 then 'abc' when c_custkey % 11 = 0 then null
            else cast(cast(c_acctbal as decimal(18,2)) as string) end as latitude,
       case when c_custkey % 17 = 0 then '12.' else cast(c_custkey as string) end as longitude
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""

# --- change log and sync log ----------------------------------------------------

# Failures are logged against a table that nobody exports.
INPUTS["in_changes"] = """
select event_id as id,
       case event_type when 'click' then 'fulfillment' when 'view' then 'fulfillment'
            when 'purchase' then 'requisition' when 'signup' then 'referencedata'
            else 'stockmanagement' end as schema_name,
       case event_type when 'click' then 'orders' when 'view' then 'order_line_items'
            when 'purchase' then 'requisitions' when 'signup' then 'users'
            else 'not_mapped' end as table_name,
       case event_id % 3 when 0 then 'I' when 1 then 'U' else 'D' end as operation,
       ts as change_time, props as row_data
from events
"""

# Every resource was last synchronized some days before its latest event.
INPUTS["in_sync_logs"] = """
select event_id as id,
       case event_type when 'click' then 'fulfillment.orders'
            when 'view' then 'fulfillment.order_line_items'
            when 'purchase' then 'requisition.requisitions'
            else 'changelog.data_changes' end as resource,
       'full' as sync_type, 'S' as operation,
       case event_type when 'click' then ts - interval '5' day
            when 'view' then ts - interval '10' day
            when 'purchase' then ts - interval '15' day
            else ts - interval '20' day end as timestamp,
       value >= 20 as success
from events
"""

# Row changes with whole rows. The rows of one order status come without a
# mapped key, those of another name an unknown table, as a log may hold.
INPUTS["in_order_changes"] = """
select o_orderkey as id, 'fulfillment' as schema_name,
       case o_orderstatus when 'P' then 'not_mapped' else 'orders' end as table_name,
       case o_orderkey % 3 when 0 then 'I' when 1 then 'U' else 'D' end as operation,
       o_orderdate as change_time, o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority
from orders
"""

# --- source tables of the export ------------------------------------------------

INPUTS["src_geographic_levels"] = """
select 'L' || cast(r_regionkey as string) as id, lower(r_name) as code,
       r_regionkey as levelnumber, r_name as name
from region
"""

INPUTS["src_geographic_zones"] = """
select 'M' || cast(n_nationkey as string) as id, n_nationkey * 1000 as catchmentpopulation,
       'gz-' || lower(n_name) as code, cast(n_nationkey as decimal(8,5)) as latitude,
       cast(-n_nationkey as decimal(8,5)) as longitude, n_name as name, 'L3' as levelid,
       'P' || cast(n_regionkey as string) as parentid
from nation
"""

INPUTS["src_facilities"] = """
select 'fac-' || cast(c_custkey as string) as id, c_acctbal >= 0 as active,
       'F' || cast(c_custkey as string) as code, cast(null as string) as comment,
       c_mktsegment as description, true as enabled, c_name as name,
       'M' || cast(c_nationkey as string) as geographiczoneid
from customer
"""

INPUTS["src_lots"] = """
select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as id,
       l_linestatus = 'O' as active, 'LOT' || cast(l_partkey as string) as lotcode,
       cast(l_shipdate + interval '365' day as date) as expirationdate,
       cast(l_shipdate as date) as manufacturedate
from lineitem
"""

INPUTS["src_orders"] = """
select cast(o_orderkey as string) as id, 'u-' || cast(o_custkey as string) as createdbyid,
       o_orderdate as createddate, o_orderpriority = '1-URGENT' as emergency,
       'fac-' || cast(o_custkey as string) as facilityid,
       'ORD-' || cast(o_orderkey as string) as ordercode,
       'prog-' || substr(o_orderpriority, 1, 1) as programid,
       cast(o_totalprice as decimal(19,2)) as quotedcost,
       'fac-' || cast(o_custkey as string) as receivingfacilityid,
       'fac-' || cast(o_custkey as string) as requestingfacilityid,
       case o_orderstatus when 'F' then 'RECEIVED' when 'O' then 'ORDERED' end as status,
       cast(null as string) as supplyingfacilityid,
       o_orderdate + interval '36' hour as lastupdateddate,
       'u-' || cast(o_custkey as string) as lastupdaterid
from orders
"""

INPUTS["src_order_line_items"] = """
select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as id,
       cast(l_orderkey as string) as orderid, cast(l_partkey as string) as orderableid,
       l_quantity as orderedquantity, l_linenumber as orderableversionnumber
from lineitem
"""

INPUTS["src_orderables"] = """
select cast(p_partkey as string) as id, 1 as versionnumber,
       'C' || cast(p_partkey as string) as code, p_name as fullproductname,
       p_type as description, p_size as packroundingthreshold, p_size * 10 as netcontent,
       p_size > 25 as roundtozero
from part
"""

INPUTS["src_programs"] = """
select distinct 'prog-' || substr(o_orderpriority, 1, 1) as id, o_orderpriority as code,
       'Servico ' || o_orderpriority as name, true as active,
       cast(null as string) as description, true as periodsskippable,
       false as skipauthorization, true as shownonfullsupplytab,
       false as enabledatephysicalstockcountcompleted
from orders
"""

INPUTS["src_program_orderables"] = """
select 'po-' || cast(p_partkey as string) as id, p_size > 5 as active, p_size as dosesperpatient,
       p_brand as programid, cast(p_partkey as string) as orderableid,
       1 as orderableversionnumber, cast(p_retailprice as decimal(19,2)) as priceperpack
from part
"""

INPUTS["src_price_changes"] = """
select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as id,
       'po-' || cast(l_partkey as string) as programorderableid,
       cast(l_extendedprice as decimal(19,2)) as price,
       'u-' || cast(l_suppkey as string) as authorid, l_shipdate as occurreddate
from lineitem
"""

INPUTS["src_proofs_of_delivery"] = """
select 'pod-' || cast(o_orderkey as string) as id,
       case when o_orderstatus = 'F' then 'CONFIRMED' else 'INITIATED' end as status,
       'u-' || cast(o_custkey as string) as deliveredby,
       cast(null as string) as receivedby, cast(o_orderdate as date) as receiveddate
from orders
"""

INPUTS["src_proof_of_delivery_line_items"] = """
select 'podl-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as id,
       'pod-' || cast(l_orderkey as string) as proofofdeliveryid,
       case when l_returnflag = 'R' then 'returned' end as notes,
       l_quantity as quantityaccepted, 0 as quantityrejected,
       cast(l_partkey as string) as orderableid,
       'LOT' || cast(l_partkey as string) as lotid, cast(null as string) as vvmstatus,
       l_linestatus = 'O' as usevvm, cast(null as string) as rejectionreasonid,
       l_linenumber as orderableversionnumber
from lineitem
"""

INPUTS["src_requisitions"] = """
select 'rq-' || cast(o_orderkey as string) as id, o_orderdate as createddate,
       o_orderdate + interval '90' minute as modifieddate,
       o_orderpriority = '1-URGENT' as emergency,
       'fac-' || cast(o_custkey as string) as facilityid, 1 as numberofmonthsinperiod,
       'prog-' || substr(o_orderpriority, 1, 1) as programid, o_orderstatus as status,
       cast(null as string) as supplyingfacilityid,
       cast(o_orderdate as date) as datephysicalstockcountcompleted, false as reportonly
from orders
"""

INPUTS["src_requisition_line_items"] = """
select 'rql-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as id,
       l_linenumber as adjustedconsumption, l_linenumber + 1 as approvedquantity,
       l_linenumber + 2 as averageconsumption, l_linenumber + 3 as beginningbalance,
       l_linenumber + 4 as calculatedorderquantity,
       cast(l_tax as decimal(19,2)) as maxperiodsofstock,
       l_linenumber + 5 as maximumstockquantity, l_returnflag = 'R' as nonfullsupply,
       l_linenumber + 6 as numberofnewpatientsadded, cast(l_partkey as string) as orderableid,
       l_linenumber + 7 as packstoship, cast(l_extendedprice as decimal(19,2)) as priceperpack,
       l_linenumber + 8 as requestedquantity, l_returnflag as requestedquantityexplanation,
       l_linestatus = 'F' as skipped, l_linenumber + 9 as stockonhand,
       l_linenumber + 10 as total, l_linenumber + 11 as totalconsumedquantity,
       cast(l_extendedprice * l_quantity as decimal(19,2)) as totalcost,
       l_linenumber + 12 as totallossesandadjustments,
       l_linenumber + 13 as totalreceivedquantity, l_linenumber + 14 as totalstockoutdays,
       'rq-' || cast(l_orderkey as string) as requisitionid,
       l_linenumber + 15 as idealstockamount, l_linenumber + 16 as calculatedorderquantityisa,
       l_linenumber + 17 as additionalquantityrequired, 1 as orderableversionnumber,
       cast(l_suppkey as string) as facilitytypeapprovedproductid,
       2 as facilitytypeapprovedproductversionnumber,
       l_linenumber + 18 as numberofpatientsontreatmentnextmonth,
       l_linenumber + 19 as totalrequirement, l_linenumber + 20 as totalquantityneededbyhf,
       l_linenumber + 21 as quantitytoissue, l_linenumber + 22 as convertedquantitytoissue
from lineitem
"""

INPUTS["src_stock_events"] = """
select 'se-' || cast(event_id as string) as id, event_type as documentnumber,
       'fac-' || cast(user_id as string) as facilityid, ts as processeddate,
       'prog-1' as programid, props as signature, 'u-' || cast(user_id as string) as userid,
       value >= 10 as isshowed, true as isactive
from events
"""

INPUTS["src_stock_event_line_items"] = """
select 'sel-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as id,
       cast(null as string) as destinationfreetext, cast(null as string) as destinationid,
       'LOT' || cast(l_partkey as string) as lotid, cast(l_shipdate as date) as occurreddate,
       cast(l_partkey as string) as orderableid, l_quantity as quantity,
       l_returnflag as reasonfreetext, cast(null as string) as reasonid,
       cast(null as string) as sourcefreetext, cast(l_suppkey as string) as sourceid,
       'se-' || cast(l_orderkey as string) as stockeventid
from lineitem
"""

INPUTS["src_stock_cards"] = """
select distinct 'sc-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) as id,
       'fac-' || cast(l_suppkey as string) as facilityid,
       'LOT' || cast(l_partkey as string) as lotid, cast(l_partkey as string) as orderableid,
       'prog-1' as programid, cast(null as string) as origineventid, true as isshowed,
       true as isactive
from lineitem
"""

INPUTS["src_stock_card_line_items"] = """
select 'scl-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as id,
       cast(null as string) as destinationfreetext, l_linestatus as documentnumber,
       cast(l_shipdate as date) as occurreddate, l_shipdate as processeddate,
       l_quantity as quantity, l_returnflag as reasonfreetext, 'sig' as signature,
       cast(null as string) as sourcefreetext, 'u-' || cast(l_suppkey as string) as userid,
       'se-' || cast(l_orderkey as string) as origineventid,
       'sc-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) as stockcardid
from lineitem
"""

INPUTS["src_calculated_stocks_on_hand"] = """
select 'soh-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) as id,
       cast(sum(l_quantity) as bigint) as stockonhand, max(cast(l_shipdate as date)) as occurreddate,
       'sc-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) as stockcardid,
       max(l_shipdate) as processeddate
from lineitem group by l_partkey, l_suppkey
"""

INPUTS["src_supported_programs"] = """
select distinct true as active, cast('2024-01-31' as date) as startdate,
       'fac-' || cast(o_custkey as string) as facilityid,
       'prog-' || substr(o_orderpriority, 1, 1) as programid, false as locallyfulfilled
from orders
"""

INPUTS["src_users"] = """
select 'u-' || cast(c_custkey as string) as id, c_acctbal >= 0 as active, c_name as firstname,
       c_mktsegment as lastname, 'UTC' as timezone, lower(c_name) as username,
       c_acctbal > 100 as verified, 'fac-' || cast(c_custkey as string) as homefacilityid,
       cast(null as string) as jobtitle, cast(null as string) as phonenumber
from customer
"""

# --- roles and contacts ---------------------------------------------------------

# A role per priority, a right per order status, a user per customer.
INPUTS["in_role_rights"] = """
select distinct md5(o_orderstatus) as rightid, 'role-' || o_orderpriority as roleid
from orders where o_orderpriority <> '3-MEDIUM' or o_orderstatus <> 'F'
"""

INPUTS["in_role_assignments"] = """
select 'role-' || o_orderpriority as roleid, 'u-' || cast(o_custkey as string) as userid
from orders
"""

INPUTS["in_contacts"] = """
select 'u-' || cast(c_custkey as string) as referencedatauserid,
       case when c_acctbal < 0 then null
            else lower(replace(c_name, '#', '')) || '@example.org' end as email
from customer
"""


def needed(sql: str, views: dict[str, str] = INPUTS) -> list[str]:
    """The views a statement mentions, each after those it depends on."""
    names = re.compile(r"\b(" + "|".join(views) + r")\b")
    found: list[str] = []
    for name in dict.fromkeys(names.findall(sql)):
        for view in [*needed(views[name], views), name]:
            if view not in found:
                found.append(view)
    return found


def with_inputs(sql: str, views: dict[str, str] = INPUTS) -> str:
    """Prefix a statement with the views it mentions."""
    ctes = [f"{name} as ({views[name].strip()})" for name in needed(sql, views)]
    return "with " + ",\n".join(ctes) + "\n" + sql.strip() if ctes else sql.strip()


class Tables:
    """The test tables of one folder, and the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def __getitem__(self, name: str) -> DataFrame:
        sql = with_inputs(f"select * from {name}")
        used = [table for table in BASE_TABLES if re.search(rf"\b{table}\b", sql)]
        for table in used:
            self.base(table).createOrReplaceTempView(table)
        return self.spark.sql(sql)
