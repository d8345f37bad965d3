"""The SQL that checks the queries, written apart from the operators."""

from __future__ import annotations

from workload.inputs import INPUTS, with_inputs

SQL: dict[str, str] = {}
VIEWS: dict[str, str] = dict(INPUTS)

TIME = "2024-06-01T00:00:00Z"

# --- export ---------------------------------------------------------------------

# Per table: target name, key, and the row as target name and value.
_EXPORTS = {
    "geographic_levels": (
        "geographic_level", "id", "'id', id, 'code', code, 'level', levelnumber, 'name', name"
    ),
    "geographic_zones": (
        "geographic_zone", "id",
        """'id', id, 'catchment_population', catchmentpopulation, 'code', code,
        'latitude', cast(latitude as varchar), 'longitude', cast(longitude as varchar),
        'name', name, 'level_id', levelid, 'parent_id', parentid""",
    ),
    "facilities": (
        "facility", "id",
        """'id', id, 'active', active, 'code', code, 'comment', comment,
        'description', description, 'enabled', enabled, 'name', name,
        'geographic_zone_id', geographiczoneid""",
    ),
    "lots": (
        "lot", "id",
        """'id', id, 'active', active, 'code', lotcode,
        'expiration_date', cast(expirationdate as varchar),
        'manufacture_date', cast(manufacturedate as varchar)""",
    ),
    "orders": (
        "order", "id",
        """'id', id, 'created_by_id', createdbyid, 'created_date', cast(createddate as varchar),
        'emergency', emergency, 'facility_id', facilityid, 'order_code', ordercode,
        'program_id', programid, 'quoted_cost', cast(quotedcost as varchar),
        'receiving_facility_id', receivingfacilityid,
        'requesting_facility_id', requestingfacilityid, 'status', status,
        'supplying_facility_id', supplyingfacilityid,
        'last_updated_date', cast(lastupdateddate as varchar),
        'last_updater_id', lastupdaterid""",
    ),
    "order_line_items": (
        "order_line", "id",
        """'id', id, 'order_id', orderid, 'product_id', orderableid,
        'ordered_quantity', orderedquantity,
        'product_version_number', orderableversionnumber""",
    ),
    "orderables": (
        "product", "id",
        """'id', id, 'version_number', versionnumber, 'code', code, 'name', fullproductname,
        'description', description, 'pack_rounding_threshold', packroundingthreshold,
        'net_content', netcontent, 'round_to_zero', roundtozero""",
    ),
    "programs": (
        "program", "id",
        """'id', id, 'code', code, 'name', name, 'active', active, 'description', description,
        'period_sskippable', periodsskippable, 'skipauthorization', skipauthorization,
        'shown_on_full_supply_tab', shownonfullsupplytab,
        'enable_date_physical_stock_count_completed', enabledatephysicalstockcountcompleted""",
    ),
    "program_orderables": (
        "program_product", "id",
        """'id', id, 'active', active, 'doses_per_patient', dosesperpatient,
        'program_id', programid, 'product_id', orderableid,
        'product_version_number', orderableversionnumber,
        'price_per_pack', cast(priceperpack as varchar)""",
    ),
    "price_changes": (
        "price_changes", "id",
        """'id', id, 'program_product_id', programorderableid, 'price', cast(price as varchar),
        'author_id', authorid, 'occurred_date', cast(occurreddate as varchar)""",
    ),
    "proofs_of_delivery": (
        "proof_of_delivery", "id",
        """'id', id, 'status', status, 'delivered_by', deliveredby, 'received_by', receivedby,
        'received_date', cast(receiveddate as varchar)""",
    ),
    "proof_of_delivery_line_items": (
        "proof_of_delivery_line", "id",
        """'id', id, 'proof_of_delivery_id', proofofdeliveryid, 'notes', notes,
        'quantity_accepted', quantityaccepted, 'quantity_rejected', quantityrejected,
        'product_id', orderableid, 'lot_id', lotid, 'vvm_status', vvmstatus, 'use_vvm', usevvm,
        'rejection_reason_id', rejectionreasonid,
        'product_version_number', orderableversionnumber""",
    ),
    "requisitions": (
        "requisition", "id",
        """'id', id, 'created_date', cast(createddate as varchar),
        'modified_date', cast(modifieddate as varchar), 'emergency', emergency,
        'facility_id', facilityid, 'months_in_period', numberofmonthsinperiod,
        'program_id', programid, 'status', status, 'supplying_facility_id', supplyingfacilityid,
        'stock_count_date', cast(datephysicalstockcountcompleted as varchar),
        'report_only', reportonly""",
    ),
    "requisition_line_items": (
        "requisition_line", "id",
        """'id', id, 'adjusted_consumption', adjustedconsumption,
        'approved_quantity', approvedquantity, 'average_consumption', averageconsumption,
        'beginning_balance', beginningbalance,
        'calculated_order_quantity', calculatedorderquantity,
        'max_periods_of_stock', cast(maxperiodsofstock as varchar),
        'max_stock_quantity', maximumstockquantity, 'non_full_supply', nonfullsupply,
        'new_patients_added', numberofnewpatientsadded, 'product_id', orderableid,
        'packs_to_ship', packstoship, 'price_per_pack', cast(priceperpack as varchar),
        'requested_quantity', requestedquantity,
        'requested_quantity_explanation', requestedquantityexplanation, 'skipped', skipped,
        'stock_on_hand', stockonhand, 'total', total,
        'total_consumed_quantity', totalconsumedquantity,
        'total_cost', cast(totalcost as varchar),
        'total_losses_and_adjustments', totallossesandadjustments,
        'total_received_quantity', totalreceivedquantity,
        'total_stockout_days', totalstockoutdays, 'requisition_id', requisitionid,
        'ideal_stock_amount', idealstockamount,
        'calculated_order_quantity_isa', calculatedorderquantityisa,
        'additional_quantity_required', additionalquantityrequired,
        'product_version_number', orderableversionnumber,
        'facility_type_approved_product_id', facilitytypeapprovedproductid,
        'facility_type_approved_product_version_number',
        facilitytypeapprovedproductversionnumber,
        'patients_on_treatment_next_month', numberofpatientsontreatmentnextmonth,
        'total_requirement', totalrequirement,
        'total_quantity_needed_by_hf', totalquantityneededbyhf,
        'quantity_to_issue', quantitytoissue,
        'converted_quantity_to_issue', convertedquantitytoissue""",
    ),
    "stock_events": (
        "stock_event", "id",
        """'id', id, 'document_number', documentnumber, 'facility_id', facilityid,
        'processed_date', cast(processeddate as varchar), 'program_id', programid,
        'signature', signature, 'user_id', userid, 'is_showed', isshowed,
        'is_active', isactive""",
    ),
    "stock_event_line_items": (
        "stock_event_line", "id",
        """'id', id, 'destination_freetext', destinationfreetext,
        'destination_id', destinationid, 'lot_id', lotid,
        'occurred_date', cast(occurreddate as varchar), 'product_id', orderableid,
        'quantity', quantity, 'reason_freetext', reasonfreetext, 'reason_id', reasonid,
        'source_freetext', sourcefreetext, 'source_id', sourceid,
        'stock_event_id', stockeventid""",
    ),
    "stock_cards": (
        "stock_card", "id",
        """'id', id, 'facility_id', facilityid, 'lot_id', lotid, 'product_id', orderableid,
        'program_id', programid, 'origin_event_id', origineventid, 'is_showed', isshowed,
        'is_active', isactive""",
    ),
    "stock_card_line_items": (
        "stock_card_line", "id",
        """'id', id, 'destination_freetext', destinationfreetext,
        'document_number', documentnumber, 'occurred_date', cast(occurreddate as varchar),
        'processed_date', cast(processeddate as varchar), 'quantity', quantity,
        'reason_freetext', reasonfreetext, 'signature', signature,
        'source_freetext', sourcefreetext, 'user_id', userid,
        'origin_event_id', origineventid, 'stock_card_id', stockcardid""",
    ),
    "calculated_stocks_on_hand": (
        "stock_on_hand", "id",
        """'id', id, 'stock_on_hand', stockonhand,
        'occurred_date', cast(occurreddate as varchar), 'stock_card_id', stockcardid,
        'processed_date', cast(processeddate as varchar)""",
    ),
    "supported_programs": (
        "supported_program", "facilityid || '|' || programid",
        """'active', active, 'start_date', cast(startdate as varchar),
        'facility_id', facilityid, 'program_id', programid,
        'locally_fulfilled', locallyfulfilled""",
    ),
    "users": (
        "user", "id",
        """'id', id, 'active', active, 'first_name', firstname, 'last_name', lastname,
        'timezone', timezone, 'username', username, 'verified', verified,
        'home_facility_id', homefacilityid, 'job_title', jobtitle,
        'phone_number', phonenumber""",
    ),
}

for _table, (_target, _key, _row) in _EXPORTS.items():
    SQL[f"export_{_table}"] = f"""
select md5('{_target}|' || {_key} || '|{TIME}') as id, '' as schema_name,
       '{_target}' as table_name, 'S' as operation, '{TIME}' as change_time,
       cast(json_object({_row}) as varchar) as row_data
from src_{_table}
"""

SQL["export_run"] = "\nunion all\n".join(
    SQL[f"export_{table}"].strip() for table in _EXPORTS
)

# The schema of each exported table.
_SCHEMA_OF = {
    table: schema
    for schema, tables in {
        "referencedata": "geographic_levels geographic_zones facilities lots orderables programs"
        " program_orderables price_changes supported_programs users",
        "fulfillment": "orders order_line_items proofs_of_delivery proof_of_delivery_line_items",
        "requisition": "requisitions requisition_line_items",
        "stockmanagement": "stock_events stock_event_line_items stock_cards stock_card_line_items"
        " calculated_stocks_on_hand",
    }.items()
    for table in tables.split()
}

SQL["export_run_log"] = "\nunion all\n".join(
    f"""select '{schema}.{table}' as resource, 'full' as sync_type, 'S' as operation,
       timestamp '2024-06-01' as "timestamp", true as success,
       cast(null as varchar) as message, cast(null as varchar) as details"""
    for table, schema in _SCHEMA_OF.items()
)

SQL["export_run_counts"] = "\nunion all\n".join(
    f"select '{target}' as table_name, count(*) as envelopes from src_{table}"
    for table, (target, _, _) in _EXPORTS.items()
)

# --- change log -----------------------------------------------------------------

SQL["last_sync_marks"] = """
select resource, max("timestamp") as last_change from in_sync_logs group by resource
"""

SQL["last_sync_marks_successful"] = """
select resource, max("timestamp") as last_change from in_sync_logs where success
group by resource
"""

SQL["last_success_row"] = """
select * from in_sync_logs where success and resource = 'fulfillment.orders'
order by "timestamp" desc, id desc limit 1
"""


def _incremental(condition: str) -> str:
    return f"""
select c.* from in_changes c
left join (select resource, max("timestamp") as last_change from in_sync_logs
           where {condition} group by resource) own
  on own.resource = c.schema_name || '.' || c.table_name
left join (select max("timestamp") as last_change from in_sync_logs
           where {condition} and resource = 'changelog.data_changes') whole on true
where c.change_time > greatest(coalesce(own.last_change, timestamp '1970-01-01'),
                               coalesce(whole.last_change, timestamp '1970-01-01'))
"""


SQL["changelog_incremental"] = _incremental("true")
SQL["changelog_incremental_successful"] = _incremental("success")
SQL["changelog_first_run"] = "select *, 'full' as sync_type from in_changes"
SQL["changelog_repeated_run"] = (
    f"select *, 'change' as sync_type from ({_incremental('true')}) due"
)

_ORDER_ENVELOPE = """
       md5('order|' || cast(id as varchar) || '|'
           || strftime(change_time, '%Y-%m-%dT%H:%M:%SZ')) as id,
       '' as schema_name, 'order' as table_name, operation,
       strftime(change_time, '%Y-%m-%dT%H:%M:%SZ') as change_time,
       cast(json_object(
           'id', cast(o_orderkey as varchar), 'created_by_id', 'u-' || cast(o_custkey as varchar),
           'created_date', cast(o_orderdate as varchar),
           'emergency', o_orderpriority = '1-URGENT',
           'facility_id', 'fac-' || cast(o_custkey as varchar),
           'order_code', 'ORD-' || cast(o_orderkey as varchar),
           'program_id', substr(o_orderpriority, 1, 1),
           'quoted_cost', cast(floor(o_totalprice) as bigint),
           'receiving_facility_id', o_custkey, 'requesting_facility_id', o_custkey,
           'status', o_orderstatus, 'supplying_facility_id', null,
           'last_updated_date', cast(o_orderdate as varchar),
           'last_updater_id', o_custkey) as varchar) as row_data
"""

SQL["changelog_envelopes"] = f"""
select {_ORDER_ENVELOPE} from in_order_changes where o_orderstatus not in ('P', 'O')
"""

# A changed row as its log has it; the rows of one status lack two keys.
_ORDER_LOGGED = """cast(case o_orderstatus when 'O' then json_object(
           'id', cast(o_orderkey as varchar), 'createdbyid', 'u-' || cast(o_custkey as varchar),
           'createddate', cast(o_orderdate as varchar),
           'emergency', o_orderpriority = '1-URGENT',
           'facilityid', 'fac-' || cast(o_custkey as varchar),
           'ordercode', 'ORD-' || cast(o_orderkey as varchar),
           'quotedcost', cast(floor(o_totalprice) as bigint),
           'receivingfacilityid', o_custkey, 'requestingfacilityid', o_custkey,
           'supplyingfacilityid', null, 'lastupdateddate', cast(o_orderdate as varchar),
           'lastupdaterid', o_custkey, 'extradata', 'not mapped')
       else json_object(
           'id', cast(o_orderkey as varchar), 'createdbyid', 'u-' || cast(o_custkey as varchar),
           'createddate', cast(o_orderdate as varchar),
           'emergency', o_orderpriority = '1-URGENT',
           'facilityid', 'fac-' || cast(o_custkey as varchar),
           'ordercode', 'ORD-' || cast(o_orderkey as varchar),
           'programid', substr(o_orderpriority, 1, 1),
           'quotedcost', cast(floor(o_totalprice) as bigint),
           'receivingfacilityid', o_custkey, 'requestingfacilityid', o_custkey,
           'status', o_orderstatus, 'supplyingfacilityid', null,
           'lastupdateddate', cast(o_orderdate as varchar), 'lastupdaterid', o_custkey,
           'extradata', 'not mapped') end as varchar)"""

SQL["changelog_rejects"] = f"""
select id, schema_name, table_name,
       case when o_orderstatus = 'P' then 'unmapped_table' else 'missing_key' end as reason,
       case when o_orderstatus = 'O' then 'programid,status' end as missing,
       {_ORDER_LOGGED} as row_data
from in_order_changes where o_orderstatus in ('P', 'O')
"""

_MIXED = ("facilities", "orderables", "programs", "geographic_levels", "users")

SQL["changelog_mixed_tables"] = "\nunion all\n".join(
    f"""select md5('{_EXPORTS[table][0]}|{number}-' || id || '|{TIME}') as id,
       '' as schema_name, '{_EXPORTS[table][0]}' as table_name, 'U' as operation,
       '{TIME}' as change_time, cast(json_object({_EXPORTS[table][2]}) as varchar) as row_data
       from src_{table}"""
    for number, table in enumerate(_MIXED)
)

SQL["changelog_retained"] = """
select * from in_changes where change_time > timestamp '2024-01-15'
"""

SQL["changelog_cleared_parts"] = SQL["changelog_retained"]

SQL["changelog_after_full_export"] = f"""
select {_ORDER_ENVELOPE} from in_order_changes
where o_orderstatus not in ('P', 'O') and change_time > timestamp '1995-06-01'
"""

SQL["changelog_run"] = f"""
select 'sent' as status, table_name, id, schema_name, operation, change_time, row_data,
       o_orderkey as change_id, 'fulfillment' as source_schema, 'orders' as source_table,
       cast(null as varchar) as reason, cast(null as varchar) as missing
from (select o_orderkey, {_ORDER_ENVELOPE} from in_order_changes
      where o_orderstatus not in ('P', 'O')) sent
union all
select 'rejected', case o_orderstatus when 'P' then 'unmapped' else 'order' end, null, '',
       operation, strftime(change_time, '%Y-%m-%dT%H:%M:%SZ'), {_ORDER_LOGGED}, id, schema_name,
       table_name, case o_orderstatus when 'P' then 'unmapped_table' else 'missing_key' end,
       case when o_orderstatus = 'O' then 'programid,status' end
from in_order_changes where o_orderstatus in ('P', 'O')
"""

SQL["changelog_stream_log"] = """
select 'changelog.data_changes' as resource, 'change' as sync_type, 'S' as operation,
       max(change_time) as "timestamp", true as success, cast(null as varchar) as message,
       cast(null as varchar) as details
from in_order_changes
"""

SQL["changelog_stream"] = f"""
select {_ORDER_ENVELOPE} from in_order_changes where o_orderstatus not in ('P', 'O')
and change_time > (
    select greatest(
        max(case when resource = 'fulfillment.orders' then "timestamp" - interval '26' year end),
        max(case when resource = 'changelog.data_changes'
            then "timestamp" - interval '26' year end))
    from in_sync_logs)
"""

# --- undeclared records, split reads --------------------------------------------

SQL["fields_inferred"] = f"""
select field, case kind when 'UBIGINT' then 'long' when 'BIGINT' then 'long'
                        when 'BOOLEAN' then 'boolean' else 'string' end as type
from (
    select field, json_extract_string(shape, '$.' || field) as kind
    from (
        select shape, unnest(json_keys(shape)) as field
        from (select json_group_structure(cast({_ORDER_LOGGED} as json)) as shape from in_order_changes) s
    ) f
) k
"""

SQL["records_inferred"] = """
select id as change_id, 'u-' || cast(o_custkey as varchar) as createdbyid,
       cast(o_orderdate as varchar) as createddate, o_orderpriority = '1-URGENT' as emergency,
       'not mapped' as extradata, 'fac-' || cast(o_custkey as varchar) as facilityid,
       cast(o_orderkey as varchar) as id, cast(o_orderdate as varchar) as lastupdateddate,
       cast(o_custkey as bigint) as lastupdaterid,
       'ORD-' || cast(o_orderkey as varchar) as ordercode,
       case when o_orderstatus <> 'O' then substr(o_orderpriority, 1, 1) end as programid,
       cast(floor(o_totalprice) as bigint) as quotedcost,
       cast(o_custkey as bigint) as receivingfacilityid,
       cast(o_custkey as bigint) as requestingfacilityid,
       case when o_orderstatus <> 'O' then o_orderstatus end as status,
       cast(null as varchar) as supplyingfacilityid
from in_order_changes
"""


def _bounds(rows: str, key: str, parts: int) -> str:
    order = ", ".join(f"{name} nulls first" for name in key.split(", "))
    return f"""
select distinct {key}, n, total from (
    select {key}, row_number() over (order by {order}) - 1 as place,
           rank() over (order by {order}) - 1 as n, count(*) over () as total
    from {rows}
) ranked where floor(place * {parts} / total) > floor((place - 1) * {parts} / total)
"""


SQL["split_bounds"] = _bounds("lineitem", "l_shipdate, l_orderkey, l_linenumber", 16)
SQL["split_bounds_of_few_keys"] = _bounds(
    "(select case when l_returnflag <> 'N' then l_returnflag end as flag from lineitem) f",
    "flag", 16,
)

SQL["split_reads"] = """
select cast(part as bigint) as part, count(*) as orders,
       min(struct_pack(a := o_orderpriority, b := o_orderkey)).a as o_orderpriority,
       min(struct_pack(a := o_orderpriority, b := o_orderkey)).b as o_orderkey
from (
    select o_orderpriority, o_orderkey,
           ((row_number() over (order by o_orderpriority, o_orderkey) - 1) * 12)
               // count(*) over () as part
    from orders
) placed group by part
"""

# --- validation -----------------------------------------------------------------

_NUMBER = r"'^-?\d+(\.\d+)?$'"

VIEWS["valid_records"] = """
select * from in_records
where name <> '' and code <> '' and municipality <> '' and province <> ''
"""

SQL["validate_kept"] = f"""
select id, code, name, municipality, province,
       case when regexp_matches(latitude, {_NUMBER}) then cast(latitude as double) end
           as latitude_num,
       case when regexp_matches(longitude, {_NUMBER}) then cast(longitude as double) end
           as longitude_num
from valid_records
"""

VIEWS["rejected"] = f"""
select code, 'missing_mandatory' as reason,
       concat_ws(',', case when coalesce(name, '') = '' then 'name' end,
                 case when coalesce(code, '') = '' then 'code' end,
                 case when coalesce(municipality, '') = '' then 'municipality' end,
                 case when coalesce(province, '') = '' then 'province' end) as columns
from in_records
where coalesce(name, '') = '' or coalesce(code, '') = '' or coalesce(municipality, '') = ''
   or coalesce(province, '') = ''
union all
select code, 'bad_coordinate',
       concat_ws(',',
           case when not coalesce(regexp_matches(latitude, {_NUMBER}), false)
                then 'latitude' end,
           case when not coalesce(regexp_matches(longitude, {_NUMBER}), false)
                then 'longitude' end)
from valid_records
where not coalesce(regexp_matches(latitude, {_NUMBER}), false)
   or not coalesce(regexp_matches(longitude, {_NUMBER}), false)
"""

SQL["validate_rejects"] = "select *, cast(null as varchar) as raw from rejected"

SQL["coordinate_flags"] = f"""
select id, coalesce(regexp_matches(latitude, {_NUMBER}), false) as latitude_valid,
       coalesce(regexp_matches(longitude, {_NUMBER}), false) as longitude_valid
from in_records
"""

SQL["records_from_json"] = """
select r.id, cast(null as varchar) as reference_id, r.code, r.name, r.is_deleted,
       r.is_operational, r.latitude, r.longitude, r.category, r.municipality, r.province,
       coalesce('[' || string_agg(cast(json_object('name', s.name, 'code', s.code) as varchar),
                ',' order by s.name) filter (where s.code is not null) || ']', '[]') as services,
       cast(null as varchar) as raw_record
from in_records r left join in_services s on s.facility_code = r.code
group by all
"""

# --- reference tables -----------------------------------------------------------

VIEWS["hierarchy"] = """
select z.id, z.name, z.levelid, z.parentid, l.levelnumber, p.name as parentname
from in_zones z left join in_levels l on z.levelid = l.id
left join in_zones p on z.parentid = p.id
"""

_SUPPORT = """cast(json_object('id', program_id, 'supportActive', active,
    'supportLocallyFulfilled', locallyfulfilled,
    'supportStartDate', cast(startdate as varchar)) as varchar)"""

VIEWS["program_entries"] = """
select sp.facilityid, coalesce(p.code, 'undefined') as code, p.id as program_id, sp.active,
       sp.locallyfulfilled, sp.startdate
from in_supported sp left join in_programs p on sp.programid = p.id
where sp.facilityid in (select s2.facilityid from in_supported s2
                        join in_programs p2 on s2.programid = p2.id)
"""

VIEWS["program_texts"] = f"""
select facilityid,
       '{{' || string_agg('"' || code || '":' || {_SUPPORT}, ',' order by length(code), code)
           || '}}' as programs,
       '[' || string_agg({_SUPPORT}, ',' order by length(code), code) || ']' as program_list
from program_entries group by facilityid
"""

VIEWS["existing"] = """
select f.id, f.name, f.code, f.active, f.enabled, f.typeid, z2.id as geographiczoneid,
       coalesce(t.programs, '{}') as supported_programs,
       coalesce(t.program_list, '[]') as program_list
from in_facilities f
left join in_zones z on z.id = f.geographiczoneid
left join in_zones z2 on z2.id = z.parentid
left join program_texts t on t.facilityid = f.id
"""

SQL["zone_hierarchy"] = "select * from hierarchy"
SQL["zones_of_level"] = "select id, name, parentname from hierarchy where levelnumber = 3"
SQL["existing_facilities"] = "select * exclude (program_list) from existing"
SQL["program_lists_from_json"] = "select id, program_list as programs from existing"
SQL["facility_program_entries"] = """
select facilityid, code, program_id as id, active as "supportActive",
       locallyfulfilled as "supportLocallyFulfilled",
       cast(startdate as varchar) as "supportStartDate"
from program_entries
"""

SQL["contacts_by_right"] = """
select rr.rightid, c.*
from in_role_rights rr
join in_role_assignments ra on ra.roleid = rr.roleid
join in_contacts c on c.referencedatauserid = ra.userid
"""

SQL["recipients_of_report"] = """
select distinct c.email
from in_role_rights rr
join in_role_assignments ra on ra.roleid = rr.roleid
join in_contacts c on c.referencedatauserid = ra.userid
where rr.rightid = md5('F') and c.email is not null
"""

# --- facilities -----------------------------------------------------------------

_NEW_SUPPORT = """cast(json_object('id', p.id, 'supportActive', true,
    'supportLocallyFulfilled', false, 'supportStartDate', null) as varchar)"""

VIEWS["record_programs"] = f"""
select s.facility_code,
       '{{' || string_agg('"' || s.code || '":' || {_NEW_SUPPORT}, ',' order by s.code) || '}}'
           as program_ids
from in_services s join in_programs p on s.code = p.code
group by s.facility_code
"""

VIEWS["enriched"] = """
select r.*, m.id as municipality_id, m.name as municipality_name, pr.id as province_id,
       ty.id as type_id, ty.name as type_name, coalesce(rp.program_ids, '{}') as program_ids
from valid_records r
left join (select * from hierarchy where levelnumber = 3) m on r.municipality = m.name
left join (select * from hierarchy where levelnumber = 2) pr on r.province = pr.name
left join in_types ty on r.category = ty.name
left join record_programs rp on rp.facility_code = r.code
"""

SQL["enrich_records"] = """
select id, code, municipality_id, province_id, type_id, type_name, program_ids from enriched
"""

SQL["enrich_records_by_province"] = """
select r.id, r.code, m.id as municipality_id, pr.id as province_id, ty.id as type_id,
       ty.name as type_name
from valid_records r
left join (select * from hierarchy where levelnumber = 3) m
  on r.municipality = m.name and r.province = m.parentname
left join (select * from hierarchy where levelnumber = 2) pr on r.province = pr.name
left join in_types ty on r.category = ty.name
"""

SQL["program_ids_by_join"] = """
select r.id, coalesce(p.program_ids, '{}') as program_ids
from in_records r left join record_programs p on p.facility_code = r.code
"""

VIEWS["matched"] = """
select e.*, x.id as existing_id, x.name as existing_name, x.active as existing_active,
       x.enabled as existing_enabled, x.geographiczoneid as existing_zone,
       x.typeid as existing_type, x.program_list as existing_programs,
       case when e.is_deleted and x.id is not null then 'disable'
            when not e.is_deleted and x.id is null then 'create'
            when not e.is_deleted and x.id is not null then 'update' end as action
from enriched e left join existing x on e.code = x.code
"""

SQL["split_actions"] = """
select r.id, r.code, f.id as existing_id,
       case when r.is_deleted = true and f.id is not null then 'disable'
            when r.is_deleted = false and f.id is null then 'create'
            when r.is_deleted = false then 'update' end as action
from valid_records r left join in_facilities f on f.code = r.code
"""

SQL["split_actions_stored"] = SQL["split_actions"]

VIEWS["sides"] = """
select *, coalesce(municipality_id, existing_zone, 'Z-UNKNOWN') as new_zone,
       coalesce(existing_zone, 'Z-UNKNOWN') as old_zone,
       coalesce(type_id, existing_type, 'T-UNKNOWN') as new_type,
       coalesce(existing_type, 'T-UNKNOWN') as old_type,
       action <> 'disable' as new_enabled
from matched where action is not null
"""

VIEWS["flags"] = """
select *, name <> existing_name as d_name, is_operational <> existing_active as d_active,
       new_enabled <> existing_enabled as d_enabled,
       new_zone <> old_zone and new_zone <> 'Z-UNKNOWN' as d_zone,
       new_type <> old_type and new_type <> 'T-UNKNOWN' as d_type
from sides
"""

VIEWS["decided"] = """
select *, action = 'create' or coalesce(
    cast(d_name as int) + cast(d_active as int) + cast(d_enabled as int) + cast(d_zone as int)
    + cast(d_type as int) > 0, false) as any_change
from flags
"""


def _payload(enabled: str, programs: str, zone: str = "new_zone", kind: str = "new_type") -> str:
    return f"""'{{"id":' || coalesce('"' || existing_id || '"', 'null') || ',"code":"' || code
       || '","name":"' || name || '","geographicZone":{{"id":' || coalesce('"' || {zone} || '"',
       'null') || '}},"type":{{"id":' || coalesce('"' || {kind} || '"', 'null')
       || '}},"active":' || coalesce(cast(is_operational as varchar), 'null')
       || ',"enabled":{enabled},"openLmisAccessible":{enabled},"supportedPrograms":'
       || {programs} || '}}'"""


def _actions(action: str, payload: str) -> str:
    return f"""
select action, existing_id as target_id, code, {payload} as payload
from decided where action = '{action}' and any_change
"""


SQL["create_actions"] = _actions("create", _payload("true", "'[]'"))
SQL["update_actions"] = _actions("update", _payload("true", "existing_programs"))
SQL["disable_actions"] = _actions("disable", _payload("false", "existing_programs"))

SQL["update_actions_null_safe"] = f"""
select action, existing_id as target_id, code, {_payload("true", "existing_programs")} as payload
from sides
where action = 'update' and (
    name is distinct from existing_name or is_operational is distinct from existing_active
    or new_enabled is distinct from existing_enabled
    or (new_zone is distinct from old_zone and new_zone <> 'Z-UNKNOWN')
    or (new_type is distinct from old_type and new_type <> 'T-UNKNOWN'))
"""

# Existing entries come first, then those of the record that are not among them.
VIEWS["merged_texts"] = """
select m.id, '[' || string_agg(e.support, ',' order by e.place, length(e.code) * e.width, e.code)
           || ']' as programs
from matched m join (
    select facilityid, code, 0 as place, 1 as width,
           cast(json_object('id', program_id, 'supportActive', active,
               'supportLocallyFulfilled', locallyfulfilled,
               'supportStartDate', cast(startdate as varchar)) as varchar) as support
    from program_entries
    union all
    select f.id, s.code, 1, 0,
           cast(json_object('id', p.id, 'supportActive', true, 'supportLocallyFulfilled', false,
               'supportStartDate', null) as varchar)
    from in_services s join in_programs p on s.code = p.code
    join in_facilities f on f.code = s.facility_code
    where not exists (select 1 from program_entries pe
                      where pe.facilityid = f.id and pe.code = s.code)
) e on e.facilityid = m.existing_id
group by m.id
"""

SQL["update_actions_merged"] = f"""
select action, existing_id as target_id, code, {_payload("true", "programs")} as payload
from (select d.*, coalesce(t.programs, '[]') as programs
      from decided d left join merged_texts t on t.id = d.id
      where d.action = 'update' and d.any_change) merged
"""

# A missing fallback makes the flags of zone and type unknown where they differ or not.
SQL["update_actions_without_fallback"] = f"""
select action, existing_id as target_id, code,
       {_payload("true", "existing_programs", "plain_zone", "plain_type")} as payload
from (select *, coalesce(municipality_id, existing_zone) as plain_zone,
             coalesce(type_id, existing_type) as plain_type from flags) plain
where action = 'update'
  and plain_zone is not distinct from existing_zone
  and plain_type is not distinct from existing_type
  and coalesce(cast(d_name as int) + cast(d_active as int) + cast(d_enabled as int) > 0, false)
"""

SQL["changed_fields"] = """
select id, any_change,
       concat_ws(',', case when d_name then 'name' end, case when d_active then 'active' end,
                 case when d_enabled then 'enabled' end,
                 case when d_enabled then 'openLmisAccessible' end,
                 case when d_zone then 'geographicZone' end,
                 case when d_type then 'type' end) as changed
from decided where action = 'update'
"""

VIEWS["known"] = """
select r.id, r.code as facility_code, f.id as facility_id
from valid_records r join in_facilities f on f.code = r.code
"""

SQL["merged_programs"] = """
select k.id, e.code, e.program_id, cast(e.startdate as varchar) as start_date
from known k join program_entries e on e.facilityid = k.facility_id
union all
select k.id, s.code, p.id, null
from known k join in_services s on s.facility_code = k.facility_code
join in_programs p on p.code = s.code
where not exists (select 1 from program_entries e
                  where e.facilityid = k.facility_id and e.code = s.code)
"""

SQL["import_metrics"] = f"""
select metric, cast(value as bigint) as value from (
    select 'incoming' as metric, count(*) as value from in_records
    union all select 'valid', count(*) from valid_records
    union all select 'invalid',
        (select count(*) from in_records) - (select count(*) from valid_records)
    union all select 'bad_coordinate', count(*) from valid_records
        where not coalesce(regexp_matches(latitude, {_NUMBER}), false)
           or not coalesce(regexp_matches(longitude, {_NUMBER}), false)
    union all select 'matched', count(*) from matched
    union all select 'no_action', count(*) from matched where action is null
    union all select 'create', count(*) from decided where action = 'create'
    union all select 'update_candidates', count(*) from decided where action = 'update'
    union all select 'update', count(*) from decided where action = 'update' and any_change
    union all select 'disable_candidates', count(*) from decided where action = 'disable'
    union all select 'disable', count(*) from decided where action = 'disable' and any_change
) counts
"""

# --- missing reference rows -----------------------------------------------------

# Accents as the test names have them; sharp s is spelled out.
_FOLD = "replace(strip_accents(lower({})), 'ß', 'ss')"

VIEWS["new_provinces"] = f"""
select distinct 'gz-' || {_FOLD.format("province")} || '-p' as code, province as name,
       'L2' as level_id, 'Z0' as parent_id
from valid_records where province not in (select name from hierarchy where levelnumber = 2)
"""

VIEWS["new_municipalities"] = f"""
select distinct 'gz-' || {_FOLD.format("r.municipality")} || '-m' as code,
       r.municipality as name, 'L3' as level_id, p.id as parent_id, n.code as parent_code
from valid_records r
left join (select * from hierarchy where levelnumber = 2) p on p.name = r.province
left join new_provinces n on n.name = r.province
where r.municipality not in (select name from hierarchy where levelnumber = 3)
"""

VIEWS["new_types"] = f"""
select {_FOLD.format("category")} as code, category as name,
       cast((select max(displayorder) from in_types)
            + row_number() over (order by category) as integer) as "displayOrder",
       true as active
from (select distinct category from valid_records
      where category is not null and category not in (select name from in_types)) missing
"""

VIEWS["new_programs"] = """
select distinct s.code, s.name, s.name as description, true as active
from valid_records r join in_services s on s.facility_code = r.code
where not exists (select 1 from in_programs p where p.code = s.code)
"""

SQL["create_provinces"] = "select * from new_provinces"
SQL["create_municipalities"] = """
select *, cast(null as varchar) as reason from new_municipalities
"""
SQL["create_municipalities_only"] = """
select code, name, parent_id, case when parent_id is null then 'unknown_province' end as reason
from new_municipalities
"""
SQL["create_types"] = "select * from new_types"
SQL["create_programs"] = "select * from new_programs"

SQL["create_types_of_customers"] = f"""
select {_FOLD.format("c_name")} as code, c_name as name,
       cast((select max(displayorder) from in_types)
            + row_number() over (order by c_name) as integer) as "displayOrder",
       true as active
from (select distinct c_name from customer
      where c_name not in (select name from in_types)) missing
"""

SQL["records_missing_municipality"] = """
select distinct code, name, municipality, province from valid_records
where municipality not in (select name from hierarchy where levelnumber = 3)
"""

VIEWS["run_actions"] = f"""
select action, code, existing_id as target_id,
       case action when 'create' then {_payload("true", "'[]'")}
            when 'update' then {_payload("true", "existing_programs")}
            else {_payload("false", "existing_programs")} end as payload
from decided where any_change
"""


def _disabled(listed: str) -> str:
    return f"""
select 'disable' as action, x.code, x.id as target_id,
       '{{"id":"' || x.id || '","code":"' || x.code || '","name":"' || x.name
       || '","geographicZone":{{"id":"' || coalesce(x.geographiczoneid, 'Z-UNKNOWN')
       || '"}},"type":{{"id":"' || x.typeid || '"}},"active":'
       || coalesce(cast(x.active as varchar), 'null')
       || ',"enabled":false,"openLmisAccessible":false,"supportedPrograms":' || x.program_list
       || '}}' as payload
from existing x
where x.enabled and not exists (select 1 from {listed} r where r.code = x.code)
"""


SQL["disable_absent"] = _disabled("in_records")


def _text(value: str) -> str:
    return f"coalesce('\"' || {value} || '\"', 'null')"


VIEWS["run_creations"] = f"""
select 'create_province' as action, code,
       '{{"code":"' || code || '","name":"' || name || '","level":{{"id":' || {_text("level_id")}
       || '}},"parent":{{"id":' || {_text("parent_id")} || '}}}}' as payload
from new_provinces
union all
select 'create_municipality', code,
       '{{"code":"' || code || '","name":"' || name || '","level":{{"id":' || {_text("level_id")}
       || '}},"parent":{{"id":' || {_text("parent_id")} || '}},"parent_code":'
       || {_text("parent_code")} || '}}'
from new_municipalities where parent_id is not null or parent_code is not null
union all
select 'create_type', code,
       '{{"code":"' || code || '","name":"' || name || '","displayOrder":'
       || cast("displayOrder" as varchar) || ',"active":true}}'
from new_types
union all
select 'create_program', code,
       '{{"code":"' || code || '","name":"' || name || '","description":"' || description
       || '","active":true}}'
from new_programs
"""

VIEWS["run_written"] = f"""
select action, code, target_id, payload from run_actions
union all {_disabled("in_records")}
union all select action, code, null, payload from run_creations
"""

SQL["import_run"] = "select * from run_written"
SQL["import_stream"] = "select * from run_written"
SQL["import_stream_in_batches"] = "select * from run_written"

SQL["import_rejects"] = """
select *, cast(null as varchar) as raw from rejected
union all
select code, 'unknown_province', 'province', cast(null as varchar)
from (select distinct code, name, province from valid_records
      where province not in (select name from hierarchy where levelnumber = 2)) provinces
union all
select code, 'unknown_municipality', 'municipality', cast(null as varchar)
from (select distinct code, name, municipality, province from valid_records
      where municipality not in (select name from hierarchy where levelnumber = 3)) places
"""

_KINDS = (
    "create", "update", "disable", "create_province", "create_municipality", "create_type",
    "create_program",
)

SQL["import_run_metrics"] = f"""
select * from ({SQL["import_metrics"]}) counted
where metric not in ({", ".join(f"'{kind}'" for kind in _KINDS)})
""" + "".join(
    f"union all select '{kind}', (select count(*) from run_written where action = '{kind}')\n"
    for kind in _KINDS
)

# The same views over a later delivery, in which every ninth customer has another name.
_LATER = {
    **VIEWS,
    "in_records": f"""
select * replace (case when cast(substr(id, 5) as bigint) % 9 = 0 and name <> ''
                       then name || ' Novo' else name end as name)
from ({VIEWS["in_records"]}) first_delivery
""",
}

# Statements over other views than the rest.
WHOLE: dict[str, str] = {
    "import_repeated": with_inputs(
        "\nunion all\n".join(
            f"""select action, code, target_id, payload from ({SQL[f"{kind}_actions"]}) acts
            where cast(substr(code, 2) as bigint) % 9 = 0"""
            for kind in ("create", "update", "disable")
        ),
        _LATER,
    )
}

SQL["import_repeated_metrics"] = f"""
select * from ({SQL["import_metrics"]}) counted
where metric in ('incoming', 'valid', 'invalid', 'bad_coordinate')
union all select 'matched', count(*) from matched where action is null
union all select 'no_action', count(*) from matched where action is null
""" + "".join(
    f"union all select '{kind}', cast(0 as bigint)\n"
    for kind in (*_KINDS, "update_candidates", "disable_candidates")
)

# --- report ---------------------------------------------------------------------

VIEWS["lines"] = """
select name, code, coalesce(nullif(municipality_name, ''), 'UNDEFINED') as municipality,
       coalesce(nullif(type_name, ''), 'UNDEFINED') as type, upper(action) as operation
from decided where any_change and action in ('create', 'update')
"""

SQL["report_lines"] = "select * from lines"


def _pages(lines: str) -> str:
    return f"""
select part, 'Facilities Sync Completion Notification - Part ' || cast(part as varchar)
           as subject, count(*) as lines,
       'Dear Administrator,' || chr(10) || chr(10)
       || 'The recent synchronization process has finished.' || chr(10) || chr(10)
       || 'Please review the resources below and make the necessary manual adjustments.'
       || chr(10) || chr(10) || 'Resources:' || chr(10)
       || rtrim(string_agg('> ' || name || ' ' || code || ' (' || operation || ')' || chr(10)
           || '        Geographic Zone: ' || municipality || chr(10)
           || '        Facility Type: ' || type || chr(10) || chr(10) || chr(10), ''
           order by n), chr(10) || ' ')
       || chr(10)
       || 'Please manually update the resources listed above and verify the changes.'
       || chr(10) as body
from (select *, row_number() over (order by operation, code, name, municipality, type) as n,
             (row_number() over (order by operation, code, name, municipality, type) - 1) // 500
                 + 1 as part
      from {lines}) numbered
group by part
"""


SQL["report_parts"] = _pages("lines")
SQL["import_report"] = SQL["report_parts"]
SQL["import_deliveries"] = f"""
select email as recipient, part
from ({SQL["recipients_of_report"]}) addresses
cross join (select distinct (row_number() over (order by code) - 1) // 500 + 1 as part from lines)
    pages
"""
SQL["report_parts_of_segments"] = _pages(
    """(select c_mktsegment as name, o_orderpriority as code, 'UNDEFINED' as municipality,
        'UNDEFINED' as type, o_orderstatus as operation
        from orders join customer on o_custkey = c_custkey) segment_lines"""
)

# --- lookups --------------------------------------------------------------------

SQL["lookup_by_id"] = "select id, code, name from in_facilities where id = 'fac-8'"
SQL["lookup_by_code"] = "select id, code, name from in_facilities where code = 'F8'"
SQL["lookup_by_codes"] = """
select id, code, name from in_facilities
where code in (select facility_code from in_services where code = '1-URGENT')
"""
SQL["supported_pair"] = """
select * from in_supported where facilityid = 'fac-8' and programid = 'prog-1'
"""
SQL["supported_by_program"] = """
select sp.* from in_supported sp join in_programs p on p.id = sp.programid
where p.code = '2-HIGH'
"""
SQL["supported_by_facility"] = """
select sp.* from in_supported sp join in_facilities f on f.id = sp.facilityid
where f.code = 'F8'
"""
SQL["supported_by_both"] = """
select sp.* from in_supported sp join in_programs p on p.id = sp.programid
join in_facilities f on f.id = sp.facilityid
where p.code = '2-HIGH' and f.code = 'F8'
"""
SQL["facilities_in_detail"] = """
select f.id, z.name as zone_name, o.code as operator_code, ty.name as type_name,
       ty.displayorder as type_order
from in_facilities f left join in_zones z on z.id = f.geographiczoneid
left join in_operators o on o.id = f.operatedbyid
left join in_types ty on ty.id = f.typeid
"""
SQL["catalog_tables"] = """
select 'referencedata.types' as source_table, id, name from in_types
union all select 'referencedata.operators', id, name from in_operators
union all select 'referencedata.programs', id, name from in_programs
union all select 'referencedata.levels', id, name from in_levels
"""

# --- functions ------------------------------------------------------------------

SQL["accent_fold_documents"] = f"select doc_id, {_FOLD.format('text')} as folded from documents"
SQL["uuid_check"] = "select event_id, event_type <> 'error' as valid from events"
SQL["iso_times"] = "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso from events"
SQL["present_or_default"] = """
select id, coalesce(nullif(name, ''), 'UNDEFINED') as name,
       coalesce(nullif(province, ''), 'UNDEFINED') as province
from in_records
"""


def statements() -> dict[str, str]:
    return {**{name: with_inputs(sql, VIEWS) for name, sql in SQL.items()}, **WHOLE}
