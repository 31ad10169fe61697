"""Nothing vanishes on the way in, and "first" is the first document."""

import json

from conftest import rows

from pricewright import fixed_values as fv
from pricewright.plans import star
from pricewright.schemas import TABLES, TOPUP_RECORD, fields
from pricewright.sources import raw, tables


def lines(tmp_path, name, texts):
    folder = tmp_path / name
    folder.mkdir(exist_ok=True)
    for i, text in enumerate(texts):
        (folder / f"part-{i}.json").write_text("\n".join(text) + "\n", encoding="utf-8")
    return str(folder)


def test_broken_documents_are_rejects(spark, tmp_path):
    good = json.dumps(raw.embedded_document(), ensure_ascii=False)
    path = lines(tmp_path, "raw", [[good, '{"topup": {"a": '], ["no json at all"]])
    documents = raw.read_raw(spark, path)
    broken = raw.unreadable_documents(documents)
    assert rows(broken) == sorted([(None, '{"topup": {"a": ', "unreadable"), (None, "no json at all", "unreadable")], key=repr)
    records, rejects = raw.branch_records(documents, "topup", TOPUP_RECORD)
    assert records.count() == len(fv.TOPUP) and rejects.count() == 0
    built, rejected = star.build_tables(documents)
    assert built["dim_game"].count() == len(fv.GAME_KEYS)
    assert rejected.filter("reject_reason = 'unreadable'").count() == 2


def test_broken_csv_rows_are_rejects(spark, tmp_path):
    names = fields(TABLES["fact_competition"]).fieldNames()
    good = ",".join("1" for _ in names)
    bad = ",".join(["x"] + ["not a number"] * (len(names) - 1))
    (tmp_path / "t.csv").write_text(",".join(names) + f"\n{good}\n{bad}\n", encoding="utf-8")
    path = str(tmp_path / "t.csv")
    assert tables.read_csv(spark, path, "fact_competition").count() == 1
    assert tables.read_csv(spark, path, "fact_competition").select(names[0]).count() == 1
    assert rows(tables.csv_rejects(spark, path, "fact_competition")) == [("fact_competition", bad, "unreadable")]


def test_the_first_document_counts(spark, tmp_path):
    one, two = raw.embedded_document(), raw.embedded_document()
    key = fv.GAME_KEYS[0]
    two["stats"][key] = {**two["stats"][key], "genre": "another", "age_distribution": {"13-17": 99}}
    two["esports"][key] = {**two["esports"][key], "competition_score": 1}
    two["topup"][key]["tiers"] = [{**t, "price_usd": 1234.5} for t in two["topup"][key]["tiers"]]
    path = lines(tmp_path, "two", [[json.dumps(one)], [json.dumps(two)]])
    alone = lines(tmp_path, "one", [[json.dumps(one)]])
    wanted, _ = star.build_tables(raw.read_raw(spark, alone))
    for spread in (1, 5):
        got, _ = star.build_tables(raw.read_raw(spark, path).repartition(spread))
        for name in ("dim_game", "fact_pricing", "dim_age", "fact_competition"):
            assert rows(got[name]) == rows(wanted[name]), name
    both = raw.read_raw(spark, lines(tmp_path, "both", [[json.dumps(one), json.dumps(two)]]))
    assert rows(star.build_tables(both)[0]["fact_pricing"]) == rows(wanted["fact_pricing"])
