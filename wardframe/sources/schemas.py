"""Declared schemas of the input tables. Fixed values, in column order of the files.

Spark's CSV reader does not enforce NOT NULL; ``audit.audit_required`` counts violations instead.
Dates are timestamps without zone, diagnosis codes strings (leading zeros, letters).
"""

from pyspark.sql.types import StructType

CLINICAL = {
    "admissions": """
        row_id int not null, subject_id int not null, hadm_id int not null,
        admittime timestamp_ntz not null, dischtime timestamp_ntz not null, deathtime timestamp_ntz,
        admission_type string not null, admission_location string not null,
        discharge_location string not null, insurance string not null, language string,
        religion string, marital_status string, ethnicity string not null,
        edregtime timestamp_ntz, edouttime timestamp_ntz, diagnosis string,
        hospital_expire_flag smallint, has_chartevents_data smallint not null""",
    "callout": """
        row_id int not null, subject_id int not null, hadm_id int not null, submit_wardid int,
        submit_careunit string, curr_wardid int, curr_careunit string, callout_wardid int,
        callout_service string not null, request_tele smallint not null,
        request_resp smallint not null, request_cdiff smallint not null,
        request_mrsa smallint not null, request_vre smallint not null,
        callout_status string not null, callout_outcome string not null, discharge_wardid int,
        acknowledge_status string not null, createtime timestamp_ntz not null,
        updatetime timestamp_ntz not null, acknowledgetime timestamp_ntz,
        outcometime timestamp_ntz not null, firstreservationtime timestamp_ntz,
        currentreservationtime timestamp_ntz""",
    "caregivers": "row_id int not null, cgid int not null, label string, description string",
    "chartevents": """
        row_id int not null, subject_id int not null, hadm_id int, icustay_id int, itemid int,
        charttime timestamp_ntz, storetime timestamp_ntz, cgid int, value string, valuenum double,
        valueuom string, warning int, error int, resultstatus string, stopped string""",
    "cptevents": """
        row_id int not null, subject_id int not null, hadm_id int not null,
        costcenter string not null, chartdate timestamp_ntz, cpt_cd string not null,
        cpt_number int, cpt_suffix string, ticket_id_seq int, sectionheader string,
        subsectionheader string, description string""",
    "datetimeevents": """
        row_id int not null, subject_id int not null, hadm_id int, icustay_id int,
        itemid int not null, charttime timestamp_ntz not null, storetime timestamp_ntz not null,
        cgid int not null, value timestamp_ntz, valueuom string not null, warning smallint,
        error smallint, resultstatus string, stopped string""",
    "diagnoses_icd": """
        row_id int not null, subject_id int not null, hadm_id int not null, seq_num int,
        icd9_code string""",
    "drgcodes": """
        row_id int not null, subject_id int not null, hadm_id int not null,
        drg_type string not null, drg_code string not null, description string,
        drg_severity smallint, drg_mortality smallint""",
    "d_cpt": """
        row_id int not null, category smallint not null, sectionrange string not null,
        sectionheader string not null, subsectionrange string not null,
        subsectionheader string not null, codesuffix string, mincodeinsubsection int not null,
        maxcodeinsubsection int not null""",
    "d_icd_diagnoses": """
        row_id int not null, icd9_code string not null, short_title string not null,
        long_title string not null""",
    "d_icd_procedures": """
        row_id int not null, icd9_code string not null, short_title string not null,
        long_title string not null""",
    "d_items": """
        row_id int not null, itemid int not null, label string, abbreviation string,
        dbsource string, linksto string, category string, unitname string, param_type string,
        conceptid int""",
    "d_labitems": """
        row_id int not null, itemid int not null, label string not null, fluid string not null,
        category string not null, loinc_code string""",
    "icustays": """
        row_id int not null, subject_id int not null, hadm_id int not null,
        icustay_id int not null, dbsource string not null, first_careunit string not null,
        last_careunit string not null, first_wardid smallint not null,
        last_wardid smallint not null, intime timestamp_ntz not null, outtime timestamp_ntz,
        los double""",
    "inputevents_cv": """
        row_id int not null, subject_id int not null, hadm_id int, icustay_id int,
        charttime timestamp_ntz, itemid int, amount double, amountuom string, rate double,
        rateuom string, storetime timestamp_ntz, cgid int, orderid int, linkorderid int,
        stopped string, newbottle int, originalamount double, originalamountuom string,
        originalroute string, originalrate double, originalrateuom string, originalsite string""",
    "inputevents_mv": """
        row_id int not null, subject_id int not null, hadm_id int, icustay_id int,
        starttime timestamp_ntz, endtime timestamp_ntz, itemid int, amount double,
        amountuom string, rate double, rateuom string, storetime timestamp_ntz, cgid int,
        orderid int, linkorderid int, ordercategoryname string, secondaryordercategoryname string,
        ordercomponenttypedescription string, ordercategorydescription string,
        patientweight double, totalamount double, totalamountuom string, isopenbag smallint,
        continueinnextdept smallint, cancelreason smallint, statusdescription string,
        comments_editedby string, comments_canceledby string, comments_date timestamp_ntz,
        originalamount double, originalrate double""",
    "labevents": """
        row_id int not null, subject_id int not null, hadm_id int, itemid int not null,
        charttime timestamp_ntz, value string, valuenum double, valueuom string, flag string""",
    "microbiologyevents": """
        row_id int not null, subject_id int not null, hadm_id int, chartdate timestamp_ntz,
        charttime timestamp_ntz, spec_itemid int, spec_type_desc string, org_itemid int,
        org_name string, isolate_num smallint, ab_itemid int, ab_name string,
        dilution_text string, dilution_comparison string, dilution_value double,
        interpretation string""",
    "noteevents": """
        row_id int not null, subject_id int not null, hadm_id int, chartdate timestamp_ntz,
        charttime timestamp_ntz, storetime timestamp_ntz, category string, description string,
        cgid int, iserror string, text string""",
    "outputevents": """
        row_id int not null, subject_id int not null, hadm_id int, icustay_id int,
        charttime timestamp_ntz, itemid int, value double, valueuom string,
        storetime timestamp_ntz, cgid int, stopped string, newbottle string, iserror int""",
    "patients": """
        row_id int not null, subject_id int not null, gender string not null,
        dob timestamp_ntz not null, dod timestamp_ntz, dod_hosp timestamp_ntz,
        dod_ssn timestamp_ntz, expire_flag int not null""",
    "prescriptions": """
        row_id int not null, subject_id int not null, hadm_id int not null, icustay_id int,
        startdate timestamp_ntz, enddate timestamp_ntz, drug_type string not null,
        drug string not null, drug_name_poe string, drug_name_generic string,
        formulary_drug_cd string, gsn string, ndc string, prod_strength string,
        dose_val_rx string, dose_unit_rx string, form_val_disp string, form_unit_disp string,
        route string""",
    "procedureevents_mv": """
        row_id int not null, subject_id int not null, hadm_id int not null, icustay_id int,
        starttime timestamp_ntz, endtime timestamp_ntz, itemid int, value double, valueuom string,
        location string, locationcategory string, storetime timestamp_ntz, cgid int, orderid int,
        linkorderid int, ordercategoryname string, secondaryordercategoryname string,
        ordercategorydescription string, isopenbag smallint, continueinnextdept smallint,
        cancelreason smallint, statusdescription string, comments_editedby string,
        comments_canceledby string, comments_date timestamp_ntz""",
    "procedures_icd": """
        row_id int not null, subject_id int not null, hadm_id int not null, seq_num int not null,
        icd9_code string not null""",
    "services": """
        row_id int not null, subject_id int not null, hadm_id int not null,
        transfertime timestamp_ntz not null, prev_service string, curr_service string""",
    "transfers": """
        row_id int not null, subject_id int not null, hadm_id int not null, icustay_id int,
        dbsource string, eventtype string, prev_careunit string, curr_careunit string,
        prev_wardid smallint, curr_wardid smallint, intime timestamp_ntz, outtime timestamp_ntz,
        los double""",
}

CCS = {
    "ccs_single_level": "ccs_id int not null, ccs_name string not null, icd9_code string not null",
    "ccs_multi_level": """
        ccs_mid string not null, ccs_name string not null, ccs_group1 string, ccs_group2 string,
        ccs_group3 string, icd9_code string not null""",
}

NOTE_LABELS = "subject_id int not null, hadm_id int, timestamp_str string, label boolean not null"

# Large event tables: bucketed by admission, sorted in reading order. One of them has no charttime.
BUCKET_KEYS = ["subject_id", "hadm_id"]
BUCKET_SORT = {
    "chartevents": ["subject_id", "hadm_id", "charttime", "row_id"],
    "inputevents_cv": ["subject_id", "hadm_id", "charttime", "row_id"],
    "inputevents_mv": ["subject_id", "hadm_id", "starttime", "row_id"],
    "labevents": ["subject_id", "hadm_id", "charttime", "row_id"],
    "noteevents": ["subject_id", "hadm_id", "charttime", "row_id"],
    "outputevents": ["subject_id", "hadm_id", "charttime", "row_id"],
}
BUCKETS = 8  # per table of a few hundred million rows; raise it with the data

# Published sizes of the full data set.
EXPECTED_ROWS = {
    "admissions": 58976, "callout": 34499, "caregivers": 7567, "chartevents": 330712483,
    "cptevents": 573146, "d_cpt": 134, "d_icd_diagnoses": 14567, "d_icd_procedures": 3882,
    "d_items": 12487, "d_labitems": 753, "datetimeevents": 4485937, "diagnoses_icd": 651047,
    "drgcodes": 125557, "icustays": 61532, "inputevents_cv": 17527935, "inputevents_mv": 3618991,
    "labevents": 27854055, "microbiologyevents": 631726, "noteevents": 2083180,
    "outputevents": 4349218, "patients": 46520, "prescriptions": 4156450,
    "procedureevents_mv": 258066, "procedures_icd": 240095, "services": 73343, "transfers": 261897,
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
