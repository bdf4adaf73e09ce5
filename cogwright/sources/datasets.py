"""The public vehicle-safety datasets that the bulk and JSON readers know, by name."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from .bulk import DatasetSpec

# The published layouts of the headerless files, in file order.
RECALL_FIELDS = (
    "RECORD_ID", "CAMPNO", "MAKETXT", "MODELTXT", "YEARTXT", "MFGCAMPNO", "COMPNAME", "MFGNAME", "BGMAN", "ENDMAN", "RCLTYPECD", "POTAFF", "ODATE",
    "INFLUENCED_BY", "MFGTXT", "RCDATE", "DATEA", "RPNO", "FMVSS", "DESC_DEFECT", "CONEQUENCE_DEFECT", "CORRECTIVE_ACTION", "NOTES", "RCL_CMPT_ID",
    "MFR_COMP_NAME", "MFR_COMP_DESC", "MFR_COMP_PTNO", "DO_NOT_DRIVE", "PARK_OUTSIDE",
)
INVESTIGATION_FIELDS = (
    "NHTSA_ACTION_NUMBER", "MAKE", "MODEL", "YEAR", "COMPNAME", "MFR_NAME", "ODATE", "CDATE", "CAMPNO", "SUBJECT", "SUMMARY",
)
COMPLAINT_FIELDS = (
    "CMPLID", "ODINO", "MFR_NAME", "MAKETXT", "MODELTXT", "YEARTXT", "CRASH", "FAILDATE", "FIRE", "INJURED", "DEATHS", "COMPDESC", "CITY", "STATE",
    "VIN", "DATEA", "LDATE", "MILES", "OCCURENCES", "CDESCR", "CMPL_TYPE", "POLICE_RPT_YN", "PURCH_DT", "ORIG_OWNER_YN", "ANTI_BRAKES_YN",
    "CRUISE_CONT_YN", "NUM_CYLS", "DRIVE_TRAIN", "FUEL_SYS", "FUEL_TYPE", "TRANS_TYPE", "VEH_SPEED", "DOT", "TIRE_SIZE", "LOC_OF_TIRE", "TIRE_FAIL_TYPE",
    "ORIG_EQUIP_YN", "MANUF_DT", "SEAT_TYPE", "RESTRAINT_TYPE", "DEALER_NAME", "DEALER_TEL", "DEALER_CITY", "DEALER_STATE", "DEALER_ZIP", "PROD_TYPE",
    "REPAIRED_YN", "MEDICAL_ATTN", "VEHICLES_TOWED_YN", "STATE_OF_INCIDENT", "VEHICLE_OPERATOR",
)
COMMUNICATION_FIELDS = (
    "NHTSA_ID_NUMBER", "REPLACEMENT_SERVICE_BULLETIN_NUMBER", "DATE_ADDED_TO_FILE", "TSB_DOCUMENT_ID", "MFR_COMMUNICATION_DATE",
    "MFR_INTERNAL_CAMPAIGN_ID_SOFTWARE_VERSION", "COMMUNICATION_TYPE", "MAKE", "MODEL", "MODEL_YEAR", "NHTSA_COMPONENTS", "MFR_COMPONENT_SYSTEM",
    "MFR_COMPONENT_SUBSYSTEM", "SUMMARY",
)
STATES_AND_TERRITORIES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "DC", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS",
    "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI",
    "WY", "AS", "GU", "MP", "PR", "VI",
)
PERIODS = (
    "1995-1999", "2000-2004", "2005-2009", "2010-2014", "2015-2019", "2020-2024", "2025-2026",
)


def _tabbed(name: str, fields: Sequence[str], identity: Sequence[str], required: Sequence[str], **roles: str) -> DatasetSpec:
    return DatasetSpec(name, tuple(fields), tuple(identity), required=tuple(required), roles=roles)


def _headed(name: str, identity: Sequence[str], required: Sequence[str], **roles: str) -> DatasetSpec:
    """Comma-separated with a header line that gives the fields."""
    return DatasetSpec(name, (), tuple(identity), delimiter=",", header=True, quote='"', required=tuple(required), roles=roles)


def _document(name: str, identity: Sequence[str], required: Sequence[str], **roles: str) -> DatasetSpec:
    """Elements of JSON documents, whose fields are their own."""
    return DatasetSpec(name, (), tuple(identity), delimiter="", required=tuple(required), roles=roles)


# Identity, required fields and the columns that play each role.
DATASETS = {
    s.name: s
    for s in (
        _headed("safety_ratings", ("MAKE", "MODEL", "MODEL_YR", "BODY_STYLE", "VEHICLE_TYPE", "DRIVE_TRAIN", "PRODUCTION_RELEASE", "FRNT_TEST_NO", "SIDE_TEST_NO", "POLE_TEST_NO"), ("MAKE", "MODEL", "MODEL_YR"), make="MAKE", model="MODEL", model_year="MODEL_YR", summary="ROLL_SAFETY_CONCERN"),
        _tabbed("recalls", RECALL_FIELDS, ("RECORD_ID",), ("RECORD_ID", "CAMPNO"), external_id="RECORD_ID", make="MAKETXT", model="MODELTXT", model_year="YEARTXT", campaign="CAMPNO", component="COMPNAME", summary="DESC_DEFECT"),
        _tabbed("investigations", INVESTIGATION_FIELDS, ("NHTSA_ACTION_NUMBER", "MAKE", "MODEL", "YEAR", "COMPNAME"), ("NHTSA_ACTION_NUMBER",), external_id="NHTSA_ACTION_NUMBER", make="MAKE", model="MODEL", model_year="YEAR", campaign="CAMPNO", component="COMPNAME", summary="SUMMARY"),
        _tabbed("complaints", COMPLAINT_FIELDS, ("CMPLID",), ("CMPLID", "ODINO"), external_id="CMPLID", make="MAKETXT", model="MODELTXT", model_year="YEARTXT", component="COMPDESC", summary="CDESCR"),
        _headed("manufacturer_communications_summary", ("TSB_DOCUMENT_ID", "MAKE", "MODEL", "MODEL_YEAR"), ("TSB_DOCUMENT_ID", "MAKE", "MODEL", "MODEL_YEAR"), external_id="TSB_DOCUMENT_ID", make="MAKE", model="MODEL", model_year="MODEL_YEAR", summary="CONCISE_SUMMARY"),
        _tabbed("manufacturer_communications", COMMUNICATION_FIELDS, COMMUNICATION_FIELDS[:-1], ("NHTSA_ID_NUMBER", "TSB_DOCUMENT_ID"), external_id="NHTSA_ID_NUMBER", make="MAKE", model="MODEL", model_year="MODEL_YEAR", component="NHTSA_COMPONENTS", summary="SUMMARY"),
        _document("vpic_makes", ("Make_ID",), ("Make_ID", "Make_Name"), external_id="Make_ID", make="Make_Name"),
        _document("vpic_models", ("Make_ID", "Model_ID"), ("Make_ID", "Make_Name", "Model_ID", "Model_Name"), external_id="Model_ID", make="Make_Name", model="Model_Name"),
        _document("vpic_model_years", ("Model_ID",), ("Make_ID", "Make_Name", "Model_ID", "Model_Name"), external_id="Model_ID", make="Make_Name", model="Model_Name"),
        _document("vpic_manufacturers", ("Mfr_ID",), ("Mfr_ID", "Mfr_Name"), external_id="Mfr_ID", make="Mfr_CommonName", summary="Mfr_Name"),
        _document("vpic_variables", ("ID",), ("ID", "Name"), external_id="ID", summary="Description"),
        _document("vpic_variable_values", ("Variable_ID", "Id"), ("Variable_ID", "Id", "Name"), external_id="Id", component="ElementName", summary="Name"),
        _document("vpic_vin_decodes", ("VIN",), ("VIN", "Make", "ModelYear", "ErrorCode"), external_id="VIN", make="Make", model="Model", model_year="ModelYear", summary="ErrorText"),
        _document("cssi_stations", ("Organization", "AddressLine1", "City", "State", "Zip", "Phone1", "ContactFirstName", "ContactLastName", "Email", "LocationLatitude", "LocationLongitude"), ("Organization", "State", "Zip"), external_id="Phone1", summary="Organization"),
    )
}


def members(dataset: str) -> list[str]:
    """The archive members that a dataset consists of."""
    by_period = {"complaints": "COMPLAINTS_RECEIVED_{}.txt", "manufacturer_communications_summary": "MFR_COMMS_RECEIVED_{}.csv", "manufacturer_communications": "TSBS_RECEIVED_{}.txt"}
    if dataset in by_period:
        return [by_period[dataset].format(p) for p in PERIODS]
    return {"safety_ratings": ["Safercar_data.csv"], "recalls": ["FLAT_RCL_PRE_2010.txt", "FLAT_RCL_POST_2010.txt"], "investigations": ["FLAT_INV.txt"]}.get(dataset, [])


@dataclass(frozen=True)
class ApiSource:
    """A document that a JSON dataset is read from."""

    key: str
    dataset: str
    url: str


def api_sources(make_ids: Iterable[int] = ()) -> list[ApiSource]:
    """The documents of the JSON datasets: the fixed ones, one for each state or territory, and one for each make's models."""
    vehicles, stations = "https://vpic.nhtsa.dot.gov/api/vehicles", "https://api.nhtsa.gov/CSSIStation/state"
    fixed = [ApiSource("vpic_all_makes", "vpic_makes", f"{vehicles}/GetAllMakes?format=json"), ApiSource("vpic_variables", "vpic_variables", f"{vehicles}/GetVehicleVariableList?format=json")]
    states = [ApiSource(f"cssi_state_{s.lower()}", "cssi_stations", f"{stations}/{s}?format=json") for s in STATES_AND_TERRITORIES]
    return fixed + states + [ApiSource(f"vpic_models_for_make_{m}", "vpic_models", f"{vehicles}/GetModelsForMakeId/{m}?format=json") for m in make_ids]
