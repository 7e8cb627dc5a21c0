"""The jobs from the command line, from the change log to a summary."""

import json

import pytest

from careflow.__main__ import main
from careflow.sinks import DimensionStore, read_summary
from tests.conftest import rows

ROUTES = {
    "doctor": "id,hospital_id",
    "patient": "id,gender,birthday",
    "hospital": "id,name",
    "dict": "id,value",
}


def change(table, data, kind="insert"):
    return json.dumps({"database": "clinic", "table": table, "type": kind, "data": data})


def visit(number, second):
    data = {
        "id": str(number),
        "create_time": f"2024-01-01 10:00:{second:02d}",
        "consultation_fee": "5.50",
        "doctor_id": "d",
        "patient_id": "p",
        "user_id": "u",
    }
    return change("consultation", data)


@pytest.mark.parametrize("batch", [True, False])
def test_from_log_to_summary(spark, folder, batch):
    records = [
        change("doctor", {"id": "d", "hospital_id": "h", "secret": "x"}),
        change("patient", {"id": "p", "gender": "101", "birthday": "2000-01-01"}),
        change("hospital", {"id": "h", "name": "First"}),
        change("dict", {"id": "101", "value": "男"}),
        change("hospital", {"id": "h", "name": "Renamed"}, "update"),
        "not json",
        *(visit(n, second) for n, second in enumerate([1, 2, 11, 40])),
    ]
    ordered = [json.dumps({**json.loads(r), "xid": n}) if r.startswith("{") else r for n, r in enumerate(records)]
    spark.createDataFrame([(r,) for r in ordered], "value string").coalesce(1).write.text(f"{folder}/log")
    config = [
        json.dumps(
            {
                "op": "c",
                "ts": number,
                "after": {
                    "source_table": name,
                    "sink_table": f"dim_{name}",
                    "sink_family": "info",
                    "sink_columns": columns,
                    "sink_row_key": "id",
                },
            }
        )
        for number, (name, columns) in enumerate(ROUTES.items())
        if name != "dict"
    ]
    spark.createDataFrame([(r,) for r in config], "value string").coalesce(1).write.text(f"{folder}/config-log")
    route = ("dict", "dim_dict", "info", ROUTES["dict"], "id")
    form = "parquet" if batch else "json"
    spark.createDataFrame([route], "a string, b string, c string, d string, e string").write.format(form).save(f"{folder}/routes")

    def run(*arguments):
        mode = ["--batch"] if batch else ["--checkpoint", f"{folder}/ckpt-{'-'.join(arguments[:2])}"]
        main([*arguments, *mode], spark)

    with pytest.raises(ValueError, match="order"):
        run("land", "--format", "text", "--path", f"{folder}/log", "--out", f"{folder}/ods")
    run("land", "--format", "text", "--order", "xid", "--path", f"{folder}/log", "--out", f"{folder}/ods")
    run("land-config", "--format", "text", "--order", "ts", "--path", f"{folder}/config-log", "--out", f"{folder}/config")
    assert spark.read.parquet(f"{folder}/ods").count() == len(records)
    run("dimensions", "--landed", f"{folder}/ods", "--config", f"{folder}/config", "--routes", f"{folder}/routes", "--routes-format", form, "--store", f"{folder}/dims")
    main(["compact", "--store", f"{folder}/dims"], spark)
    assert rows(DimensionStore(spark, f"{folder}/dims").read("dim_hospital", ["name"])) == [("h", "Renamed")]
    run("fact", "consultation", "--landed", f"{folder}/ods", "--sink-format", "text", "--out", f"{folder}/topic")
    summary = ["summary", "consultation", "--format", "text", "--path", f"{folder}/topic", "--out", f"{folder}/out"]
    live = [] if batch else ["--live"]
    run(*summary, "--store", f"{folder}/dims", "--as-of", "2024-02-01", *live)
    got = read_summary(spark, f"{folder}/out/dws_trade_hosp_pat_gen_a_g_consul_win").orderBy("stt").collect()
    assert [(r.stt[-2:], r.hospital_name, r.patient_gender, r.age_group, r.consultation_count) for r in got] == [
        ("00", "Renamed", "男", "青年期", 2),
        ("10", "Renamed", "男", "青年期", 1),
        *([("40", "Renamed", "男", "青年期", 1)] if batch else []),
    ]


def test_batches_and_streams_share_their_output(spark, folder):
    """Batch, stream, batch, and a stream with a new checkpoint: every row once; a named batch replaces itself."""

    def land(number, *mode):
        record = json.dumps({**json.loads(visit(number, number)), "xid": number})
        spark.createDataFrame([(record,)], "value string").write.text(f"{folder}/log-{number}")
        source = ["--format", "text", "--order", "xid", "--path", f"{folder}/log-{number}"]
        main(["land", *source, "--out", f"{folder}/ods", *mode], spark)
        log = ["--format", "text", "--path", f"{folder}/log-{number}"]
        main(["fact", "consultation", *log, "--sink-format", "text", "--out", f"{folder}/topic", *([*mode[:1], *(f"{m}-fact" for m in mode[1:2])] if mode[0] == "--checkpoint" else mode)], spark)

    land(1, "--batch")
    land(2, "--checkpoint", f"{folder}/one")
    land(3, "--batch", "--run", "mine")
    land(4, "--checkpoint", f"{folder}/two")
    land(5, "--batch", "--run", "mine")
    wanted = ["1", "2", "4", "5"]
    from careflow.sources import read_landed, read_topic

    assert rows(read_landed(spark, f"{folder}/ods").selectExpr("data['id']")) == [(n,) for n in wanted]
    topic = read_topic(spark, format="text", path=f"{folder}/topic")
    assert sorted(json.loads(r.value)["id"] for r in topic.collect()) == wanted
