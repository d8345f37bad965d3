"""The exported resources: which table goes out under which names."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ResourceSpec:
    """One exported table.

    ``columns`` pairs every target name with its source column, ``text``
    names source columns sent as strings, ``key`` identifies a row.
    """

    schema: str
    table: str
    target: str
    columns: tuple[tuple[str, str], ...]
    text: tuple[str, ...] = ()
    key: tuple[str, ...] = ("id",)

    @property
    def name(self) -> str:
        return f"{self.schema}.{self.table}"

    @property
    def sources(self) -> tuple[str, ...]:
        return tuple(source for _, source in self.columns)


# Resource, target and column names are the contract with the
# receiving system, odd spellings included. Parents come before children, which
# is the order a full export keeps.
RESOURCES: tuple[ResourceSpec, ...] = (
    ResourceSpec(
        "referencedata",
        "geographic_levels",
        "geographic_level",
        (
            ("id", "id"),
            ("code", "code"),
            ("level", "levelnumber"),
            ("name", "name"),
        ),
    ),
    ResourceSpec(
        "referencedata",
        "geographic_zones",
        "geographic_zone",
        (
            ("id", "id"),
            ("catchment_population", "catchmentpopulation"),
            ("code", "code"),
            ("latitude", "latitude"),
            ("longitude", "longitude"),
            ("name", "name"),
            ("level_id", "levelid"),
            ("parent_id", "parentid"),
        ),
    ),
    ResourceSpec(
        "referencedata",
        "facilities",
        "facility",
        (
            ("id", "id"),
            ("active", "active"),
            ("code", "code"),
            ("comment", "comment"),
            ("description", "description"),
            ("enabled", "enabled"),
            ("name", "name"),
            ("geographic_zone_id", "geographiczoneid"),
        ),
    ),
    ResourceSpec(
        "referencedata",
        "lots",
        "lot",
        (
            ("id", "id"),
            ("active", "active"),
            ("code", "lotcode"),
            ("expiration_date", "expirationdate"),
            ("manufacture_date", "manufacturedate"),
        ),
        text=("expirationdate", "manufacturedate"),
    ),
    ResourceSpec(
        "fulfillment",
        "orders",
        "order",
        (
            ("id", "id"),
            ("created_by_id", "createdbyid"),
            ("created_date", "createddate"),
            ("emergency", "emergency"),
            ("facility_id", "facilityid"),
            ("order_code", "ordercode"),
            ("program_id", "programid"),
            ("quoted_cost", "quotedcost"),
            ("receiving_facility_id", "receivingfacilityid"),
            ("requesting_facility_id", "requestingfacilityid"),
            ("status", "status"),
            ("supplying_facility_id", "supplyingfacilityid"),
            ("last_updated_date", "lastupdateddate"),
            ("last_updater_id", "lastupdaterid"),
        ),
        text=("createddate", "lastupdateddate", "quotedcost"),
    ),
    ResourceSpec(
        "fulfillment",
        "order_line_items",
        "order_line",
        (
            ("id", "id"),
            ("order_id", "orderid"),
            ("product_id", "orderableid"),
            ("ordered_quantity", "orderedquantity"),
            ("product_version_number", "orderableversionnumber"),
        ),
    ),
    ResourceSpec(
        "referencedata",
        "orderables",
        "product",
        (
            ("id", "id"),
            ("version_number", "versionnumber"),
            ("code", "code"),
            ("name", "fullproductname"),
            ("description", "description"),
            ("pack_rounding_threshold", "packroundingthreshold"),
            ("net_content", "netcontent"),
            ("round_to_zero", "roundtozero"),
        ),
    ),
    ResourceSpec(
        "referencedata",
        "programs",
        "program",
        (
            ("id", "id"),
            ("code", "code"),
            ("name", "name"),
            ("active", "active"),
            ("description", "description"),
            ("period_sskippable", "periodsskippable"),
            ("skipauthorization", "skipauthorization"),
            ("shown_on_full_supply_tab", "shownonfullsupplytab"),
            ("enable_date_physical_stock_count_completed", "enabledatephysicalstockcountcompleted"),
        ),
    ),
    ResourceSpec(
        "referencedata",
        "program_orderables",
        "program_product",
        (
            ("id", "id"),
            ("active", "active"),
            ("doses_per_patient", "dosesperpatient"),
            ("program_id", "programid"),
            ("product_id", "orderableid"),
            ("product_version_number", "orderableversionnumber"),
            ("price_per_pack", "priceperpack"),
        ),
        text=("priceperpack",),
    ),
    ResourceSpec(
        "referencedata",
        "price_changes",
        "price_changes",
        (
            ("id", "id"),
            ("program_product_id", "programorderableid"),
            ("price", "price"),
            ("author_id", "authorid"),
            ("occurred_date", "occurreddate"),
        ),
        text=("occurreddate", "price"),
    ),
    ResourceSpec(
        "fulfillment",
        "proofs_of_delivery",
        "proof_of_delivery",
        (
            ("id", "id"),
            ("status", "status"),
            ("delivered_by", "deliveredby"),
            ("received_by", "receivedby"),
            ("received_date", "receiveddate"),
        ),
        text=("receiveddate",),
    ),
    ResourceSpec(
        "fulfillment",
        "proof_of_delivery_line_items",
        "proof_of_delivery_line",
        (
            ("id", "id"),
            ("proof_of_delivery_id", "proofofdeliveryid"),
            ("notes", "notes"),
            ("quantity_accepted", "quantityaccepted"),
            ("quantity_rejected", "quantityrejected"),
            ("product_id", "orderableid"),
            ("lot_id", "lotid"),
            ("vvm_status", "vvmstatus"),
            ("use_vvm", "usevvm"),
            ("rejection_reason_id", "rejectionreasonid"),
            ("product_version_number", "orderableversionnumber"),
        ),
    ),
    ResourceSpec(
        "requisition",
        "requisitions",
        "requisition",
        (
            ("id", "id"),
            ("created_date", "createddate"),
            ("modified_date", "modifieddate"),
            ("emergency", "emergency"),
            ("facility_id", "facilityid"),
            ("months_in_period", "numberofmonthsinperiod"),
            ("program_id", "programid"),
            ("status", "status"),
            ("supplying_facility_id", "supplyingfacilityid"),
            ("stock_count_date", "datephysicalstockcountcompleted"),
            ("report_only", "reportonly"),
        ),
        text=("createddate", "modifieddate", "datephysicalstockcountcompleted"),
    ),
    ResourceSpec(
        "requisition",
        "requisition_line_items",
        "requisition_line",
        (
            ("id", "id"),
            ("adjusted_consumption", "adjustedconsumption"),
            ("approved_quantity", "approvedquantity"),
            ("average_consumption", "averageconsumption"),
            ("beginning_balance", "beginningbalance"),
            ("calculated_order_quantity", "calculatedorderquantity"),
            ("max_periods_of_stock", "maxperiodsofstock"),
            ("max_stock_quantity", "maximumstockquantity"),
            ("non_full_supply", "nonfullsupply"),
            ("new_patients_added", "numberofnewpatientsadded"),
            ("product_id", "orderableid"),
            ("packs_to_ship", "packstoship"),
            ("price_per_pack", "priceperpack"),
            ("requested_quantity", "requestedquantity"),
            ("requested_quantity_explanation", "requestedquantityexplanation"),
            ("skipped", "skipped"),
            ("stock_on_hand", "stockonhand"),
            ("total", "total"),
            ("total_consumed_quantity", "totalconsumedquantity"),
            ("total_cost", "totalcost"),
            ("total_losses_and_adjustments", "totallossesandadjustments"),
            ("total_received_quantity", "totalreceivedquantity"),
            ("total_stockout_days", "totalstockoutdays"),
            ("requisition_id", "requisitionid"),
            ("ideal_stock_amount", "idealstockamount"),
            ("calculated_order_quantity_isa", "calculatedorderquantityisa"),
            ("additional_quantity_required", "additionalquantityrequired"),
            ("product_version_number", "orderableversionnumber"),
            ("facility_type_approved_product_id", "facilitytypeapprovedproductid"),
            ("facility_type_approved_product_version_number", "facilitytypeapprovedproductversionnumber"),
            ("patients_on_treatment_next_month", "numberofpatientsontreatmentnextmonth"),
            ("total_requirement", "totalrequirement"),
            ("total_quantity_needed_by_hf", "totalquantityneededbyhf"),
            ("quantity_to_issue", "quantitytoissue"),
            ("converted_quantity_to_issue", "convertedquantitytoissue"),
        ),
        text=("maxperiodsofstock", "totalcost", "priceperpack"),
    ),
    ResourceSpec(
        "stockmanagement",
        "stock_events",
        "stock_event",
        (
            ("id", "id"),
            ("document_number", "documentnumber"),
            ("facility_id", "facilityid"),
            ("processed_date", "processeddate"),
            ("program_id", "programid"),
            ("signature", "signature"),
            ("user_id", "userid"),
            ("is_showed", "isshowed"),
            ("is_active", "isactive"),
        ),
        text=("processeddate",),
    ),
    ResourceSpec(
        "stockmanagement",
        "stock_event_line_items",
        "stock_event_line",
        (
            ("id", "id"),
            ("destination_freetext", "destinationfreetext"),
            ("destination_id", "destinationid"),
            ("lot_id", "lotid"),
            ("occurred_date", "occurreddate"),
            ("product_id", "orderableid"),
            ("quantity", "quantity"),
            ("reason_freetext", "reasonfreetext"),
            ("reason_id", "reasonid"),
            ("source_freetext", "sourcefreetext"),
            ("source_id", "sourceid"),
            ("stock_event_id", "stockeventid"),
        ),
        text=("occurreddate",),
    ),
    ResourceSpec(
        "stockmanagement",
        "stock_cards",
        "stock_card",
        (
            ("id", "id"),
            ("facility_id", "facilityid"),
            ("lot_id", "lotid"),
            ("product_id", "orderableid"),
            ("program_id", "programid"),
            ("origin_event_id", "origineventid"),
            ("is_showed", "isshowed"),
            ("is_active", "isactive"),
        ),
    ),
    ResourceSpec(
        "stockmanagement",
        "stock_card_line_items",
        "stock_card_line",
        (
            ("id", "id"),
            ("destination_freetext", "destinationfreetext"),
            ("document_number", "documentnumber"),
            ("occurred_date", "occurreddate"),
            ("processed_date", "processeddate"),
            ("quantity", "quantity"),
            ("reason_freetext", "reasonfreetext"),
            ("signature", "signature"),
            ("source_freetext", "sourcefreetext"),
            ("user_id", "userid"),
            ("origin_event_id", "origineventid"),
            ("stock_card_id", "stockcardid"),
        ),
        text=("occurreddate", "processeddate"),
    ),
    ResourceSpec(
        "stockmanagement",
        "calculated_stocks_on_hand",
        "stock_on_hand",
        (
            ("id", "id"),
            ("stock_on_hand", "stockonhand"),
            ("occurred_date", "occurreddate"),
            ("stock_card_id", "stockcardid"),
            ("processed_date", "processeddate"),
        ),
        text=("occurreddate", "processeddate"),
    ),
    ResourceSpec(
        "referencedata",
        "supported_programs",
        "supported_program",
        (
            ("active", "active"),
            ("start_date", "startdate"),
            ("facility_id", "facilityid"),
            ("program_id", "programid"),
            ("locally_fulfilled", "locallyfulfilled"),
        ),
        text=("startdate",),
        key=("facilityid", "programid"),
    ),
    ResourceSpec(
        "referencedata",
        "users",
        "user",
        (
            ("id", "id"),
            ("active", "active"),
            ("first_name", "firstname"),
            ("last_name", "lastname"),
            ("timezone", "timezone"),
            ("username", "username"),
            ("verified", "verified"),
            ("home_facility_id", "homefacilityid"),
            ("job_title", "jobtitle"),
            ("phone_number", "phonenumber"),
        ),
    ),
)

# Fixed value: every envelope carries an empty schema name.
TARGET_SCHEMA = ""

# Operation codes of the change log and of a sync run.
INSERT, UPDATE, DELETE, SYNC = "I", "U", "D", "S"

CHANGE_LOG = "changelog.data_changes"

_BY_NAME = {spec.name: spec for spec in RESOURCES}


def resource(name: str) -> ResourceSpec:
    return _BY_NAME[name]
