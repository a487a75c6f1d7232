"""From CSV files to exported labels, end to end on a tiny hospital."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from wardframe.plans import extract, kidney, labels as L
from wardframe.sources import schemas, tables

T0 = datetime(2130, 5, 1)


def at(hours):
    return T0 + timedelta(hours=hours)


DATA = {
    "patients": [dict(row_id=i, subject_id=i, gender="MF"[i % 2], dob=datetime(2060, 1, 1), expire_flag=0)
                 for i in (1, 2, 3)],
    "admissions": [dict(row_id=i, subject_id=i, hadm_id=10 + i, admittime=T0, dischtime=at(240),
                        admission_type="ELECTIVE", admission_location="EMERGENCY ROOM ADMIT",
                        discharge_location="HOME", insurance="Private", ethnicity="WHITE - POLISH",
                        hospital_expire_flag=0, has_chartevents_data=1) for i in (1, 2, 3)],
    "icustays": [dict(row_id=i, subject_id=i, hadm_id=10 + i, icustay_id=100 + i, dbsource="x",
                      first_careunit="MICU", last_careunit="MICU", first_wardid=1, last_wardid=1,
                      intime=at(1), outtime=at(100), los=4.0) for i in (1, 2, 3)],
    "labevents": [
        # 1: kidney injury from hour 60; 2: already on admission; 3: none
        *[dict(row_id=n, subject_id=s, hadm_id=10 + s, itemid=50912, charttime=at(h), valuenum=v)
          for n, (s, h, v) in enumerate([(1, 1, 1.0), (1, 60, 2.1), (2, 1, 1.0), (2, 20, 3.5), (3, 2, 1.0),
                                         (3, 70, 1.1)])],
        *[dict(row_id=50 + s, subject_id=s, hadm_id=10 + s, itemid=51222, charttime=at(72), valuenum=v)
          for s, v in ((1, 7.5), (2, 14.0), (3, 11.0))],
    ],
    "chartevents": [
        dict(row_id=1, subject_id=1, hadm_id=11, icustay_id=101, itemid=211, charttime=at(2), valuenum=130.0),
        dict(row_id=2, subject_id=3, hadm_id=13, icustay_id=103, itemid=224631, charttime=at(90), value="To Bone"),
        dict(row_id=3, subject_id=1, hadm_id=11, icustay_id=101, itemid=762, charttime=at(0), valuenum=80.0,
             valueuom="kg"),
        dict(row_id=4, subject_id=1, hadm_id=11, icustay_id=101, itemid=223849, charttime=at(3), value="CMV"),
        dict(row_id=5, subject_id=1, hadm_id=11, icustay_id=101, itemid=223849, charttime=at(5), value="CMV"),
    ],
    "outputevents": [dict(row_id=h, subject_id=1, hadm_id=11, icustay_id=101, charttime=at(h), itemid=40055,
                          value=100.0) for h in range(1, 5)],
    "procedureevents_mv": [],
    "services": [dict(row_id=1, subject_id=1, hadm_id=11, transfertime=at(0), curr_service="CSURG")],
    "diagnoses_icd": [dict(row_id=s, subject_id=s, hadm_id=10 + s, seq_num=1, icd9_code=c)
                      for s, c in ((1, "5849"), (2, "2800"), (3, "2800"))],
}


def text(value):
    return "" if value is None else str(value)


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hospital")
    for name, records in DATA.items():
        fields = schemas.struct(schemas.CLINICAL[name]).fieldNames()
        lines = [",".join(fields).upper(), *[",".join(text(r.get(f)) for f in fields) for r in records]]
        (folder / f"{name.upper()}.csv").write_text("\n".join(lines) + "\n")
    (folder / "ccs_single_level.csv").write_text(
        "ccs_id,ccs_name,icd9_code\n59,Deficiency anemia,2800\n157,Acute renal failure,5849\n"
    )
    (folder / "ccs_multi_level.csv").write_text(
        "ccs_mid,ccs_name,ccs_group1,ccs_group2,ccs_group3,icd9_code\n4.1,Anemia,,,,2800\n"
    )
    (folder / "notes.csv").write_text(
        "subject_id,hadm_id,timestamp_str,label\n"
        "1,11,2130-05-03T12:00,true\n2,12,2130-05-05T00:00:00,false\n3,,2130-05-01T00:00,true\n"
    )
    tables.load_catalog(spark, str(folder), "hospital", tables=DATA)
    tables.load_ccs(spark, str(folder), "hospital_ccs")
    return extract.Catalog(spark, "hospital", "hospital_ccs", "hospital_stages"), folder


def read(spark, paths):
    return {
        p.rsplit("/", 1)[1].removesuffix(".csv"): [
            tuple(r) for r in spark.read.option("header", True).csv(p).collect()
        ]
        for p in paths
    }


def test_kidney_injury(spark, catalog, tmp_path):
    c, folder = catalog
    spec = extract.aki_spec(c, str(folder / "notes.csv"))
    got = read(spark, extract.export_condition(spec, str(tmp_path), single_file=True))
    assert len(got) == 10
    assert {r[:2]: r[2:] for r in got["haaki_label_details"]} == {
        ("1", "11"): ("true", "true", "true"), ("2", "12"): ("false", "false", "false"),
        ("3", "13"): ("false", "false", "false"),
    }
    assert got["aki_stages"] == [
        ("1", "11", "2130-05-03T12:00:00.000000", "2"), ("2", "12", "2130-05-01T20:00:00.000000", "3"),
    ]
    assert got["haaki_stages"] == [("1", "11", "2130-05-03T12:00:00.000000", "2")]
    assert got["haaki_hadms"] == [("1", "11")]
    # ill on admission: no case, and no control either
    assert got["noaki_hadms"] == [("3", "13")]
    assert spark.table("hospital_stages.running_aki_stages__baseline_median").count() > 0
    # the stage is laid out by admission: jobs on it plan no exchange
    assert got["aki_stages"] and spec.stages.count() == spark.table("hospital_stages.aki_stages__baseline_median").count()
    for job in (L.table_evidence(spec, acquired=False), L.stage_onsets(spec), kidney.running_aki_stages(spec.stages)):
        assert "Exchange" not in job._jdf.queryExecution().executedPlan().toString()
    # another baseline is another stage
    extract.aki_spec(c, str(folder / "notes.csv"), "first")
    assert spark.catalog.tableExists("hospital_stages.aki_stages__baseline_first")


def test_anemia_and_pressure_injury(spark, catalog, tmp_path):
    c, folder = catalog
    notes = str(folder / "notes.csv")
    for chart in (False, True):
        spec = extract.anemia_spec(c, notes, chart_hgb=chart)
        got = read(spark, extract.export_condition(spec, str(tmp_path / f"anemia{chart}")))
        assert {r[1]: r[3] for r in got["anemia_severities"]} == {"11": "3", "13": "1"}
    spec = extract.pressure_injury_spec(c, notes)
    got = read(spark, extract.export_condition(spec, str(tmp_path / "pi")))
    assert [r[1] for r in got["hapi_positive_table_labels"]] == ["13"]
    assert [r[1] for r in got["nopi_hadms"]] == ["12"]


def test_concepts_and_demographics(spark, catalog, tmp_path):
    c, _ = catalog
    concepts = extract.concept_tables(c)
    oasis = {r["icustay_id"]: r for r in concepts["oasis"].collect()}
    assert oasis[101]["heartrate_score"] == 6 and oasis[101]["mechvent_score"] == 9
    assert oasis[101]["urineoutput"] == 400.0 and oasis[101]["electivesurgery_score"] == 0
    assert oasis[102]["mechvent"] == 0 and oasis[102]["urineoutput"] is None
    extract.export_demographics(c, str(tmp_path / "d"))
    got = read(spark, [str(tmp_path / "d")])["d"]
    assert sorted(r[8] for r in got) == ["WHITE"] * 3 and len(got) == 3
    again = extract.concept_tables(replace(c, recreate=True))["oasis"]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, oasis.values()))
