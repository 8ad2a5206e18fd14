"""Files in the declared shapes through all fifteen loads."""

import csv
import io
import random

import pytest

from tallyhouse.operators.rules import GateError
from tallyhouse.plans import ingest
from tallyhouse.schemas import TABLES
from tallyhouse.sources.csv import read_csv_staging, records, write_csv

FILES = {
    "player": """email,first_name,last_name,dob,phone,registration_date,loyalty_points
a@x,Ann,A,1990-01-01,1,2024-01-01 10:00:00,100
a@x,Anna,A,1990-01-01,1,2024-01-02 10:00:00,200
b@x,Bob,B,1991-02-30,1,2024-01-01 10:00:00,5
,No,Mail,1990-01-01,1,2024-01-01 10:00:00,5
c@x,Cy,C,1990-01-01,,2024-01-01 10:00:00,7
""",
    "staff": """staff_email,first_name,last_name,position,hire_date,salary
s1@x,Sam,S,Dealer,2020-01-01,100
s1@x,Samuel,S,Dealer,2020-01-01,100.555
s2@x,Tim,T,Manager,20-01-01,100
s3@x,Una,U,Security,2020-01-01,100.10
""",
    "casino_location": """location_code,name,address,city,state,country
L1,"One, Main","1 Road, Town",C,S,X
L2,,2 Road,C,S,X
L3,Three,3 Road,C,S,X
""",
    "game": """game_name,type,min_bet,max_bet
 G1 ,slots,1,10
g1,Slot,5,10
G2,POKER,x,20
G3,Number,1,10
""",
    "player_game": """player_email,game_name,play_time,amount_bet,amount_won
a@x,g1,2024-01-03 10:00:00,10,5.5
a@x,g1,2024-01-03 10:00:00,10,5.5
a@x,G3,2024-01-03 10:00:00,10,5
c@x,G2,2024-01-03 25:00:00,10,5
c@x,G2,2024-01-04 10:00:00,"",5
,,,,
c@x,G2,2024-01-05 10:00:00,3,0
""",
    "table_game": """table_code,game_name,location_code,status
T1,g1,L1,Available
T2,G3,L9,In Use
T3,G2,L3,
""",
    "staff_assigned_tables": """staff_email,table_code,shift_start,shift_end
s1@x,T1,2024-01-03 08:00:00,2024-01-03 16:00:00
s2@x,T1,2024-01-03 08:00:00,2024-01-03 16:00:00
s3@x,T2,2024-01-03 08:00:00,2024-01-03 16:00:00
""",
    "slot_machine": """machine_code,location_code,status,model
M1,L1,Online,A
M2,L1,Broken,A
M3,L9,Online,A
M4,L3,,B
""",
    "slot_play": """machine_code,player_email,play_time,bet_amount,win_amount
M1,a@x,2024-01-03 10:00:00,1,0
""",
    "reward": """reward_code,name,points_required,description
R1,Drink,10,"Free, cold"
""",
    "player_reward": """player_email,reward_code,redeem_date
a@x,R1,2024-01-05 10:00:00
""",
    "transaction": """transaction_code,player_email,amount,transaction_type,transaction_time,game_name
X1,a@x,10.50,Bet,2024-01-03 10:00:00,g1
X2,a@x,10.50,Deposit,2024-01-03 10:00:00,
X3,zz@x,10.50,Bet,2024-01-03 10:00:00,g1
""",
    "game_result": """result_code,game_name,table_code,result_time,outcome_description
E1,g1,T1,2024-01-03 10:00:00,won
E2,g1,,2024-01-03 10:00:00,won
E3,G3,T1,2024-01-03 10:00:00,won
E4,g1,T1,then,won
E5,g1,"",2024-01-03 10:00:00,won""",
    "login_history": """login_id,player_email,login_time,ip_address,device
0b0b0b0b-1111-2222-3333-444444444444,a@x,2024-01-03 10:00:00,1.1.1.1,"%s"
0b0b0b0b-1111-2222-3333-555555555555,zz@x,2024-01-03 10:00:00,1.1.1.1,PC
""" % ("d" * 150),
    "audit_log": '''log_code,event_type,event_time,performed_by,details
A1,Login,2024-01-03 10:00:00,s1@x,"two
lines, ""quoted"""
A2,Login,2024-01-03 10:00:00,zz@x,x
''',
}


@pytest.fixture(scope="module")
def loads(spark, tmp_path_factory):
    """All files loaded in order, each into an empty table."""
    folder = tmp_path_factory.mktemp("files")
    done, tables = {}, {}
    for name in ingest.LOAD_ORDER:
        path = folder / f"{name}.csv"
        path.write_text(FILES[name])
        done[name] = ingest.load_file(spark, name, str(path), parents=tables)
        tables[name] = done[name].rows
    return done


EXPECTED = {
    "player": [("a@x", "Anna"), ("c@x", "Cy")],
    "staff": [("s1@x", "Samuel"), ("s3@x", "Una")],
    "casino_location": [("L1", "One, Main"), ("L3", "Three")],
    "game": [("G2", "Poker"), ("g1", "Slot")],
    "player_game": [("a@x", "g1"), ("c@x", "G2")],
    "table_game": [("T1", "g1"), ("T3", "G2")],
    "staff_assigned_tables": [("s1@x", "T1")],
    "slot_machine": [("M1", "L1"), ("M4", "L3")],
    "slot_play": [("M1", "a@x")],
    "reward": [("R1", "Drink")],
    "player_reward": [("a@x", "R1")],
    "transaction": [("X1", "a@x")],
    "game_result": [("E1", "g1")],
    "login_history": [("0b0b0b0b-1111-2222-3333-444444444444", "a@x")],
    "audit_log": [("A1", "Login")],
}


@pytest.mark.parametrize("name", ingest.LOAD_ORDER)
def test_rows_that_get_in(loads, rows, name):
    first, second = list(TABLES[name].columns)[:2]
    assert rows(loads[name].rows, first, second) == EXPECTED[name]


def test_details(loads, rows):
    assert loads["audit_log"].rows.first()["details"] == 'two\nlines, "quoted"'
    assert len(loads["login_history"].rows.first()["device"]) == 100
    assert rows(loads["table_game"].rows, "table_code", "status") == [("T1", "Available"), ("T3", "Available")]
    assert rows(loads["slot_machine"].rows, "machine_code", "status") == [("M1", "Online"), ("M4", None)]
    assert str(loads["staff"].rows.where("staff_email = 's1@x'").first()["salary"]) == "100.56"
    assert [tuple(map(str, r)) for r in rows(loads["game"].rows, "game_name", "min_bet")] == [("G2", "None"), ("g1", "5.00")]


def test_reports(loads, rows):
    assert tuple(loads["player"].report.first()) == (5, 2, 0, 2)
    assert {tuple(r["reasons"]) for r in loads["player"].rejected.collect()} == {("dob not date",), ("email required",)}
    assert rows(loads["transaction"].orphans["game_name"]) == []
    assert rows(loads["transaction"].orphans["player_email"]) == [("zz@x", 1)]
    assert rows(loads["slot_machine"].rejected, "machine_code") == [("M2",)]
    assert rows(loads["game_result"].rejected, "result_code") == [("E2",), ("E4",), ("E5",)]


def test_load_again_changes_nothing(spark, loads, tmp_path):
    path = tmp_path / "player.csv"
    path.write_text(FILES["player"])
    again = ingest.load_file(spark, "player", str(path), loads["player"].rows)
    assert tuple(again.report.first()) == (5, 0, 0, 2)
    path.write_text(FILES["player"].replace("Anna", "Anne"))
    changed = ingest.load_file(spark, "player", str(path), loads["player"].rows)
    assert tuple(changed.report.first()) == (5, 0, 1, 2)


def staged(spark, name, data):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in TABLES[name].columns))


def test_gates_stop(spark, loads):
    parents = {n: load.rows for n, load in loads.items()}
    for name, data in {
        "table_game": [("T1", "g1", "L1", "Closed")],
        "slot_play": [("M1", "a@x", "now", "1", "1")],
        "reward": [("R1", None, "1", "")],
        "player_reward": [("a@x", "R1", "2024-01-01")],
        "transaction": [("X1", "a@x", "1.234", "Bet", "2024-01-01 00:00:00", "g1")],
        "audit_log": [("A1", "Login", "2024-01-01 00:00:00", None, "x")],
    }.items():
        with pytest.raises(GateError):
            ingest.load(TABLES[name], staged(spark, name, data), None, parents)
    with pytest.raises(GateError, match="unknown location_code"):
        ingest.load(TABLES["table_game"], staged(spark, "table_game", [("T1", "g1", "L9", None)]), None, parents)
    with pytest.raises(GateError, match="repeated"):
        ingest.load(TABLES["reward"], staged(spark, "reward", [("R1", "a", "1", ""), ("R1", "b", "1", "")]), None, parents)


def test_empty_row_breaks_a_gate(spark, loads):
    with pytest.raises(GateError):
        ingest.load(TABLES["reward"], staged(spark, "reward", [(None, None, None, None)]), None, {})


def test_unknown_keys_are_all_reported(spark, loads, rows):
    parents = {n: load.rows for n, load in loads.items()}
    data = staged(spark, "transaction", [("X1", "zz@x", "1", "Bet", "2024-01-01 00:00:00", "gX")])
    load = ingest.load(TABLES["transaction"], data, None, parents)
    assert rows(load.orphans["game_name"]) == [("gX", 1)] and rows(load.orphans["player_email"]) == [("zz@x", 1)]


def test_transaction_without_game_may_be_kept(spark, loads, rows):
    parents = {n: load.rows for n, load in loads.items()}
    data = staged(spark, "transaction", [("X1", "a@x", "1", "Deposit", "2024-01-01 00:00:00", None)])
    assert ingest.load(TABLES["transaction"], data, None, parents).rows.count() == 0
    assert ingest.load(TABLES["transaction"], data, None, parents, null_fk="keep").rows.count() == 1


def test_empty_and_missing_fields(spark, rows, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('a,b,c\n1,"",\n2,"x ""y""\nz",w\n')
    assert rows(read_csv_staging(spark, str(path), ["a", "b", "c"])) == [("1", "", None), ("2", 'x "y"\nz', "w")]
    assert rows(read_csv_staging(spark, str(path), ["a", "b", "c"], multiline=True)) == [("1", "", None), ("2", 'x "y"\nz', "w")]
    assert rows(read_csv_staging(spark, str(path), ["a", "b", "c"], force_null=True, multiline=True)) == [("1", None, None), ("2", 'x "y"\nz', "w")]
    out = str(tmp_path / "out")
    write_csv(read_csv_staging(spark, str(path), ["a", "b", "c"], multiline=True), out)
    assert rows(read_csv_staging(spark, out, ["a", "b", "c"], multiline=True)) == [("1", "", None), ("2", 'x "y"\nz', "w")]


def test_scan_order(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("a\n" + "\n".join(str(i) for i in range(50)) + "\n")
    for multiline in (None, False, True):
        ordered = read_csv_staging(spark, str(path), ["a"], multiline=multiline, ordered=True).orderBy("_file", "_block", "_row")
        assert [int(r["a"]) for r in ordered.collect()] == list(range(50))


@pytest.mark.parametrize("split", [30, 200, 5000])
def test_records_across_lines_and_splits(spark, tmp_path, split):
    """Quoted line breaks wherever a split may fall, fields over several splits, several files, either line end, no end at all."""
    rng = random.Random(split)
    folder, want = tmp_path / "files", []
    folder.mkdir()
    pieces = ["a", "b c", ",", '"', "\n", "\n\n", '""', "é", "\r\n", "", " "]
    for f in range(5):
        data = [[str(i), "".join(rng.choices(pieces, k=rng.randint(0, 12))), rng.choice(["x", "", "long " * 80 + "\n" + "text\n" * 30])] for i in range(40)]
        text = io.StringIO(newline="")
        csv.writer(text, lineterminator="\r\n" if f % 2 else "\n", quoting=csv.QUOTE_ALL).writerows([["id", 'he"ad\ner' if f == 3 else "t", "u"], *data])
        body = text.getvalue()
        (folder / f"{f}.csv").write_bytes((body.rstrip() if f == 4 else body).encode())
        want += [(f, *row) for row in data]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        found = read_csv_staging(spark, str(folder), ["id", "t", "u"], ordered=True)
        assert records(spark, str(folder)).select("_block").distinct().count() > 1 or split == 5000
        got = [(int(r["_file"][-5]), r["id"], r["t"], r["u"]) for r in found.orderBy("_file", "_block", "_row").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # The parser takes any line end inside quotes for a newline.
    plain = lambda x: x.replace("\r\n", "\n")
    assert [(f, i, plain(t), u) for f, i, t, u in got] == [(f, i, plain(t), u) for f, i, t, u in want]
