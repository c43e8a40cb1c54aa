import csv
import random
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vendora.functions import fixed_values as V
from vendora.functions import grouping
from vendora.functions.checksums import hash_sum
from vendora.operators import incremental, quality, scd, staging
from vendora.operators.quality import Rule
from vendora.plans import warehouse
from vendora.sources import csv_files, driver_tables, tables
from vendora.registry import QUERIES
from vendora.session import scratch, work_path
from vendora.sources.contracts import CONTRACTS
from vendora.streaming import order_feed

D = Decimal
FACT = "order_item_key string, order_date date, order_month timestamp_ntz, order_amount decimal(13,2)"


def fact(spark, rows):
    """(key, date, amount)"""
    return spark.createDataFrame([(k, d, d and datetime(d.year, d.month, 1), D(a)) for k, d, a in rows], FACT)


def content(df):
    return sorted((r["order_item_key"], str(r["order_date"]), r["order_amount"]) for r in df.collect())


OLD = [("a", date(2018, 1, 5), 1), ("b", date(2018, 2, 20), 2), ("c", date(2018, 3, 10), 3)]


@pytest.fixture()
def target(spark, tmp_path):
    path = f"{tmp_path}/target"
    incremental.full_refresh(fact(spark, OLD), path)
    return path


def test_append_takes_strictly_newer_dates_only(spark, target):
    source = fact(spark, [("same_day", date(2018, 3, 10), 9), ("new", date(2018, 3, 11), 4), ("late", date(2018, 3, 8), 5)])
    assert content(incremental.append_new(source, target)) == content(fact(spark, [*OLD, ("new", date(2018, 3, 11), 4)]))


def test_append_to_an_empty_table_takes_everything(spark, tmp_path):
    incremental.full_refresh(fact(spark, []), f"{tmp_path}/empty")
    assert content(incremental.append_new(fact(spark, OLD), f"{tmp_path}/empty")) == content(fact(spark, OLD))


def test_lookback_finds_late_rows_and_keeps_known_ones(spark, target):
    source = fact(spark, [*OLD, ("late", date(2018, 3, 8), 5), ("too_late", date(2018, 3, 3), 6), ("new", date(2018, 3, 12), 7)])
    changed = source.withColumn("order_amount", F.col("order_amount") + F.lit(D("1")).cast("decimal(3,2)")).select(
        *[F.col(c).cast(t) for c, t in fact(spark, []).dtypes])
    got = content(incremental.append_with_lookback(changed, target))
    assert got == content(fact(spark, [*OLD, ("late", date(2018, 3, 8), 6), ("new", date(2018, 3, 12), 8)]))


def test_merge_replaces_inserts_and_is_repeatable(spark, target):
    delta = fact(spark, [("b", date(2018, 2, 21), 20), ("n", date(2018, 4, 1), 4)])
    expected = content(fact(spark, [OLD[0], ("b", date(2018, 2, 21), 20), OLD[2], ("n", date(2018, 4, 1), 4)]))
    assert content(incremental.merge(delta, target)) == expected
    assert content(incremental.merge(delta, target)) == expected


def test_merge_moves_the_only_row_of_a_month(spark, target):
    moved = fact(spark, [("b", date(2018, 3, 1), 2)])
    assert content(incremental.merge(moved, target)) == content(fact(spark, [OLD[0], ("b", date(2018, 3, 1), 2), OLD[2]]))


def test_merge_leaves_other_months_untouched(spark, target):
    def files():
        return {f for f in spark.read.parquet(target).inputFiles() if "2018-01" in f}

    before = files()
    incremental.merge(fact(spark, [("c", date(2018, 3, 10), 30)]), target)
    assert files() == before


def test_merge_keeps_rows_without_a_date(spark, tmp_path):
    path = f"{tmp_path}/t"
    incremental.full_refresh(fact(spark, [*OLD, ("u", None, 7)]), path)
    got = content(incremental.merge(fact(spark, [("v", None, 8)]), path))
    assert got == content(fact(spark, [*OLD, ("u", None, 7), ("v", None, 8)]))


def test_merge_rejects_unusable_keys(spark, target):
    for rows, what in (([("b", date(2018, 2, 21), 2), ("b", date(2018, 2, 22), 3)], "not unique"), ([(None, date(2018, 2, 1), 2)], "NULL")):
        with pytest.raises(ValueError, match=what):
            incremental.merge(fact(spark, rows), target)
    assert content(spark.read.schema(FACT).parquet(target)) == content(fact(spark, OLD))


def test_merge_that_was_cut_off_is_finished(spark, target, monkeypatch):
    """The crash comes after the rows are stored and before the table is touched."""
    with monkeypatch.context() as m:
        m.setattr(incremental, "replace_partitions", lambda *a: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            incremental.merge(fact(spark, [("b", date(2018, 3, 1), 20)]), target)
    assert content(spark.read.schema(FACT).parquet(target)) == content(fact(spark, OLD))
    got = content(incremental.merge(fact(spark, [("n", date(2018, 1, 6), 5)]), target))
    assert got == content(fact(spark, [OLD[0], ("b", date(2018, 3, 1), 20), OLD[2], ("n", date(2018, 1, 6), 5)]))


def test_merge_by_month_reads_delivered_months_only(spark, target, monkeypatch):
    plans = []
    write = incremental.replace_partitions
    monkeypatch.setattr(incremental, "replace_partitions", lambda *a: (plans.append(a[0]), write(*a)))
    reads = []
    months = incremental._months
    monkeypatch.setattr(incremental, "_months", lambda df: (reads.append(df._jdf.queryExecution().toString()), months(df))[1])
    incremental.merge(fact(spark, [("c", date(2018, 3, 11), 30)]), target, key_keeps_month=True)
    assert not any("target" in r and "PartitionFilters: []" in r for r in reads)
    assert content(spark.read.schema(FACT).parquet(target)) == content(fact(spark, [*OLD[:2], ("c", date(2018, 3, 11), 30)]))


def test_merge_moves_what_it_stored_and_writes_it_once(spark, target, monkeypatch):
    """A large month is several parts; what was stored as pending is in its place by the same file names."""
    monkeypatch.setattr(incremental, "PART_ROWS", 2)
    pending, move = set(), incremental.replace_partitions
    monkeypatch.setattr(
        incremental, "replace_partitions",
        lambda df, *a: (pending.update(f.rsplit("/", 1)[1] for f in df.inputFiles()), move(df, *a))[1],
    )
    rows = [(f"k{i}", date(2018, 2, 1 + i), i) for i in range(9)] + [("b", date(2018, 3, 1), 7), ("u", None, 1)]
    expected = content(fact(spark, [OLD[0], OLD[2], *rows]))
    assert content(incremental.merge(fact(spark, rows), target)) == expected
    files = {f.rsplit("/", 1)[1] for f in spark.read.schema(FACT).parquet(target).inputFiles() if "2018-01" not in f}
    assert files <= pending
    more = [("k1", date(2018, 2, 20), 1), ("v", None, 2)]
    assert content(incremental.merge(fact(spark, more), target)) == content(
        fact(spark, [OLD[0], OLD[2], *[r for r in rows if r[0] != "k1"], *more])
    )


def test_a_merge_cut_off_between_two_months_is_finished(spark, target, monkeypatch):
    def first_only(df, stored_at, path, by, move=tables._move_partitions):
        if by == incremental.PARTITION:
            places = sorted(p for p in Path(stored_at).iterdir() if "=" in p.name)
            (Path(path) / places[0].name).exists() and __import__("shutil").rmtree(Path(path) / places[0].name)
            places[0].rename(Path(path) / places[0].name)
            raise OSError("cut off")
        move(df, stored_at, path, by)

    with monkeypatch.context() as m:
        m.setattr(tables, "_move_partitions", first_only)
        with pytest.raises(OSError):
            incremental.merge(fact(spark, [("a", date(2018, 2, 1), 10), ("n", date(2018, 3, 9), 4)]), target)
    got = content(incremental.merge(fact(spark, [("m", date(2018, 4, 1), 1)]), target))
    wanted = [("a", date(2018, 2, 1), 10), OLD[1], OLD[2], ("n", date(2018, 3, 9), 4), ("m", date(2018, 4, 1), 1)]
    assert got == content(fact(spark, wanted))


def test_lookback_appends_a_key_once(spark, target):
    twice = fact(spark, [("n", date(2018, 3, 12), 7), ("n", date(2018, 3, 12), 7), ("n", date(2018, 3, 12), 6)])
    assert content(incremental.append_with_lookback(twice, target)) == content(fact(spark, [*OLD, ("n", date(2018, 3, 12), 7)]))


def test_stream_takes_late_lines_and_spares_a_table_that_exists(spark, tmp_path):
    feed, path = f"{tmp_path}/feed", f"{tmp_path}/t"

    def deliver(rows, checkpoint):
        df = fact(spark, rows)
        df.write.mode("append").parquet(feed)
        order_feed.merge_into(order_feed.line_stream(spark, feed, df.schema), path, f"{tmp_path}/{checkpoint}")
        return content(spark.read.schema(FACT).parquet(path))

    assert deliver([*OLD, OLD[0]], "c1") == content(fact(spark, OLD))
    late = ("late", date(2017, 11, 2), 4)
    assert deliver([late], "c1") == content(fact(spark, [*OLD, late]))
    incremental.merge(fact(spark, [("own", date(2018, 1, 9), 1)]), path)
    assert deliver([OLD[1]], "c2") == content(fact(spark, [*OLD, late, ("own", date(2018, 1, 9), 1)]))


def test_stream_settles_keys_before_it_merges(spark, tmp_path, monkeypatch):
    plans, merge = [], order_feed.merge
    monkeypatch.setattr(
        order_feed, "merge", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), merge(df, *a, **k))
    )
    df = fact(spark, [*OLD, OLD[0]])
    df.write.parquet(f"{tmp_path}/feed")
    order_feed.merge_into(order_feed.line_stream(spark, f"{tmp_path}/feed", df.schema), f"{tmp_path}/t", f"{tmp_path}/c")
    assert plans and not any("Aggregate" in p for p in plans)
    assert content(spark.read.schema(FACT).parquet(f"{tmp_path}/t")) == content(fact(spark, OLD))


@pytest.fixture()
def no_markers(spark):
    """A store whose writers leave no success markers."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    name = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf.set(name, "false")
    yield
    conf.unset(name)


def test_merge_without_success_markers(spark, no_markers, tmp_path):
    path = f"{tmp_path}/t"
    incremental.full_refresh(fact(spark, OLD), path)
    got = content(incremental.merge(fact(spark, [("b", date(2018, 3, 1), 20), ("n", date(2018, 4, 1), 4)]), path))
    assert got == content(fact(spark, [OLD[0], ("b", date(2018, 3, 1), 20), OLD[2], ("n", date(2018, 4, 1), 4)]))
    assert not list(Path(path).rglob("_SUCCESS"))


def test_stream_into_a_table_without_success_markers(spark, no_markers, tmp_path):
    path, feed = f"{tmp_path}/t", f"{tmp_path}/feed"
    fact(spark, OLD).write.partitionBy("order_month").parquet(path)
    new = fact(spark, [("n", date(2018, 4, 1), 4)])
    new.write.parquet(feed)
    order_feed.merge_into(order_feed.line_stream(spark, feed, new.schema), path, f"{tmp_path}/c")
    assert content(tables.read_table(spark, path, new.schema)) == content(fact(spark, [*OLD, ("n", date(2018, 4, 1), 4)]))


def test_merge_into_nothing(spark, tmp_path):
    for path in (f"{tmp_path}/missing", f"{tmp_path}/empty"):
        Path(f"{tmp_path}/empty").mkdir(exist_ok=True)
        assert content(incremental.merge(fact(spark, OLD), path)) == content(fact(spark, OLD))


def index_of(spark, path):
    index, _ = incremental.find_index(spark, path)
    rows = incremental.read_index(spark, index, fact(spark, []).schema).collect()
    return sorted((r["order_item_key"], str(r["order_month"])[:7]) for r in rows)


def test_merge_opens_touched_buckets_and_months_only(spark, tmp_path):
    """Files of other months and other buckets are spoilt; a merge that opened one would fail."""
    path = f"{tmp_path}/t"
    rows = [(f"k{i}", date(2018, 1 + i % 6, 3), i) for i in range(60)]
    incremental.full_refresh(fact(spark, rows), path, indexed=True)
    index, buckets = incremental.find_index(spark, path)
    delta = fact(spark, [("k0", date(2018, 2, 9), 100)])
    mine = incremental._keys_of(delta, buckets).first()["bucket"]
    plan = incremental.read_index(spark, index, delta.schema, [mine])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    for file in Path(path).rglob("*.parquet"):
        where = str(file.parent)
        if not any(x in where for x in ("2018-01", "2018-02", f"bucket={mine}")):
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
            file.write_bytes(b"spoilt")
    incremental.merge(delta, path)
    left = spark.read.schema(FACT).parquet(path).filter("order_month < '2018-03-01'")
    expected = [r for r in rows[1:] if r[1].month < 3] + [("k0", date(2018, 2, 9), 100)]
    assert content(left) == content(fact(spark, expected))


def test_index_follows_every_writer(spark, tmp_path):
    path = f"{tmp_path}/t"
    incremental.full_refresh(fact(spark, OLD), path, indexed=True)
    incremental.append_new(fact(spark, [("d", date(2018, 4, 1), 4)]), path)
    incremental.append_with_lookback(fact(spark, [("e", date(2018, 4, 2), 5)]), path)
    incremental.replace_months(fact(spark, [("f", date(2018, 1, 8), 6)]), path)
    incremental.merge(fact(spark, [("d", date(2018, 5, 1), 40), ("g", None, 7)]), path)
    held = {(r["order_item_key"], str(r["order_month"])[:7]) for r in spark.read.schema(FACT).parquet(path).collect()}
    assert held <= set(index_of(spark, path))
    assert ("d", "2018-04") not in index_of(spark, path)
    got = content(incremental.merge(fact(spark, [("e", date(2018, 1, 9), 50), ("g", date(2018, 6, 1), 8)]), path))
    wanted = [("f", date(2018, 1, 8), 6), OLD[1], OLD[2], ("d", date(2018, 5, 1), 40), ("e", date(2018, 1, 9), 50)]
    assert got == content(fact(spark, [*wanted, ("g", date(2018, 6, 1), 8)]))
    incremental.full_refresh(fact(spark, OLD), path)
    assert incremental.find_index(spark, path) is None


def test_merges_in_any_order_equal_a_dictionary(spark, tmp_path, monkeypatch):
    """Random deliveries with moves and cut-offs, against the plain meaning of a merge."""
    monkeypatch.setattr(incremental, "MIN_BUCKETS", 3)
    rng, path, state = random.Random(4), f"{tmp_path}/t", {}
    for round_ in range(6):
        keys = rng.sample("abcdefghij", rng.randint(1, 5))
        rows = [(k, date(2018, rng.randint(1, 4), rng.randint(1, 28)), rng.randint(1, 99)) for k in keys]
        if round_ == 3:
            with monkeypatch.context() as m:
                m.setattr(incremental, "_write_buckets", lambda *a: (_ for _ in ()).throw(OSError("cut off")))
                with pytest.raises(OSError):
                    incremental.merge(fact(spark, rows), path)
        else:
            incremental.merge(fact(spark, rows), path)
        state |= {k: (k, d, a) for k, d, a in rows}
        incremental.recover(spark, path, fact(spark, []).schema)
        assert content(spark.read.schema(FACT).parquet(path)) == content(fact(spark, list(state.values())))


def test_stream_sets_late_lines_aside_and_loses_none(spark, tmp_path, monkeypatch):
    feed, path = f"{tmp_path}/feed", f"{tmp_path}/t"
    merged = []
    merge = order_feed.merge
    monkeypatch.setattr(order_feed, "merge", lambda rows, *a, **k: (merged.append(content(rows)), merge(rows, *a, **k))[1])

    def deliver(rows, checkpoint="c"):
        df = fact(spark, rows)
        df.coalesce(1).write.mode("append").parquet(feed)
        order_feed.merge_into(order_feed.line_stream(spark, feed, df.schema), path, f"{tmp_path}/{checkpoint}")
        return content(spark.read.schema(FACT).parquet(path))

    def late():
        return content(order_feed.late_lines(spark, path, fact(spark, []).schema))

    first = [("a", date(2018, 3, 1), 1), ("b", date(2018, 3, 20), 2), ("u", None, 3)]
    assert deliver(first) == content(fact(spark, first)) and late() == content(fact(spark, first[2:]))
    # At the mark (13 March) is late, after it is not; an unchanged line comes again, a changed one too.
    second = [("c", date(2018, 3, 13), 4), ("d", date(2018, 3, 14), 5), ("b", date(2018, 3, 20), 2), ("e", date(2017, 1, 1), 6)]
    assert deliver(second) == content(fact(spark, [*first, second[0], second[1], second[3]]))
    assert late() == content(fact(spark, [first[2], second[0], second[3]]))
    assert ("b", "2018-03-20", D("2.00")) not in merged[-1]
    third = [("b", date(2018, 3, 20), 22), ("d", date(2018, 3, 14), 5)]
    state = [first[0], first[2], second[0], second[1], second[3], third[0]]
    assert deliver(third) == content(fact(spark, state))
    # Another checkpoint starts without state and marks: everything comes again, nothing is lost.
    again = deliver([("z", date(2018, 4, 1), 9)], "other")
    assert {r[0] for r in again} == {"a", "b", "c", "d", "e", "u", "z"}
    assert late() == content(fact(spark, [first[2], first[2], second[0], second[3]]))


def test_replace_months(spark, target):
    delivered = fact(spark, [("c2", date(2018, 3, 2), 5)])
    assert content(incremental.replace_months(delivered, target)) == content(fact(spark, [*OLD[:2], ("c2", date(2018, 3, 2), 5)]))


def test_missed_rows_tell_missing_from_stale(spark):
    rebuilt = fact(spark, [OLD[0], ("b", date(2018, 2, 20), 22), ("x", date(2018, 2, 1), 5), OLD[2]])
    rows = incremental.missed_rows(fact(spark, OLD), rebuilt).collect()
    assert [(r["missing_rows"], r["stale_rows"], r["missing_amount"]) for r in rows] == [(1, 1, D("5.00"))]


def test_missed_rows_join_hashes_and_tell_zeros_nulls_and_types(spark):
    """What is joined is a key and a hash of the rest; floats and columns of two types are compared as they are."""
    kinds = "order_item_key string, order_month timestamp_ntz, order_amount decimal(13,2), x string, y string, f double, n {}"
    month = datetime(2018, 1, 1)
    old = [("a", month, D(1), None, "p", 0.0, 1), ("b", month, D(1), "p", None, 1.0, 1), ("c", month, D(1), "q", "q", 1.0, 1)]
    new = [("a", month, D(1), None, "p", -0.0, 1), ("b", month, D(1), None, "p", 1.0, 1), ("c", month, D(1), "q", "q", 1.0, 2), ("d", month, D(4), "z", "z", 1.0, 1)]
    target, rebuilt = spark.createDataFrame(old, kinds.format("int")), spark.createDataFrame(new, kinds.format("long"))
    found = incremental.missed_rows(target, rebuilt)
    assert [(r["missing_rows"], r["stale_rows"], r["missing_amount"]) for r in found.collect()] == [(1, 2, D("4.00"))]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") >= 4


def test_only_months_that_differ_are_compared(spark, target):
    """A row moved to another month, a changed one; the order of rows is no difference."""
    source = [OLD[0], ("x", date(2018, 1, 7), 9), ("b", date(2018, 4, 2), 2), ("c", date(2018, 3, 10), 3), ("u", None, 1)]
    incremental.append_new(fact(spark, [("x", date(2018, 3, 12), 9)]), target)
    stored = tables.read_table(spark, target, fact(spark, []).schema)
    rebuilt = fact(spark, source[::-1])
    months = incremental.differing_months(stored, rebuilt)
    assert sorted(str(m)[:7] for m in months) == ["2018-01", "2018-02", "2018-03", "2018-04", "None"]
    got = {str(r["order_month"])[:7]: (r["missing_rows"], r["stale_rows"]) for r in incremental.missed_rows(stored, rebuilt).collect()}
    assert got == {"2018-01": (0, 1), "2018-04": (0, 1), "None": (1, 0)}
    late = fact(spark, [*OLD, ("late", date(2018, 2, 3), 1), ("x", date(2018, 3, 12), 9)])
    assert [str(m)[:7] for m in incremental.differing_months(stored, late)] == ["2018-02"]
    plan = incremental.missed_rows(stored, late)._jdf.queryExecution().executedPlan().toString()
    assert "2018-02-01" in plan and "2018-01-01" not in plan
    assert incremental.missed_rows(stored, stored).collect() == []


# --- quoted CSV in blocks -----------------------------------------------------


@pytest.fixture()
def small_blocks(spark):
    """Files are cut every 150 bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "0"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_csv_is_cut_into_blocks(spark, small_blocks, tmp_path, end):
    """Quotes, commas and line breaks anywhere, a record longer than several blocks, no text at all."""
    rng = random.Random(len(end))
    rows = [[str(i), "".join(rng.choices(['a', '"', ",", "\n", "x y", "é"], k=rng.randint(0, 12)))] for i in range(60)]
    rows[20][1], rows[40][1] = '"line\n' * 150, "\n" * 300
    path = f"{tmp_path}/reviews.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(["id", "text"])
        writer.writerows(rows)
    assert csv_files.block_lines(spark, path).rdd.getNumPartitions() > 5
    got = [tuple(r) for r in csv_files.read_free_text(spark, path).collect()]
    assert sorted(got) == sorted((i, t or None) for i, t in rows)


def test_quoted_csv_of_several_files_keeps_one_header(spark, small_blocks, tmp_path):
    (tmp_path / "d").mkdir()
    for name, head in (("a", "id,text"), ("b", "id,text"), ("c", "")):
        body = f'{head}\n1,"{name}\n{name}"\n\n2,{name}' if head else ""
        (tmp_path / "d" / f"{name}.csv").write_text(body)
    got = sorted(tuple(r) for r in csv_files.read_free_text(spark, f"{tmp_path}/d").collect())
    assert got == [("1", "a\na"), ("1", "b\nb"), ("2", "a"), ("2", "b")]
    (tmp_path / "d" / "e.csv").write_text("text,id\nx,1\n")
    with pytest.raises(ValueError, match="headers"):
        csv_files.read_free_text(spark, f"{tmp_path}/d")


# --- slowly changing dimensions ----------------------------------------------

CUSTOMER = "customer_id string, customer_city string, updated_at timestamp_ntz"
T1, T2, T3 = datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)


def people(spark, rows):
    return spark.createDataFrame(rows, CUSTOMER)


def versions(df):
    return sorted((r["customer_id"], r["customer_city"] or "", str(r[scd.VALID_FROM]), str(r[scd.VALID_TO])) for r in df.collect())


def first(spark):
    return scd.first_snapshot(people(spark, [("1", "sao paulo", T1), ("2", "rio", T1), ("3", None, T1)]), F.col("updated_at"))


def test_timestamp_history_closes_opens_keeps_and_repeats(spark):
    source = people(spark, [("1", "rio", T2), ("2", "rio", T1), ("4", "bahia", T2)])
    once = scd.by_timestamp(first(spark), source, "customer_id", "updated_at")
    assert versions(once) == sorted([
        ("1", "sao paulo", str(T1), str(T2)), ("1", "rio", str(T2), "None"), ("2", "rio", str(T1), "None"),
        ("3", "", str(T1), "None"), ("4", "bahia", str(T2), "None"),
    ])
    assert versions(scd.by_timestamp(once, source, "customer_id", "updated_at")) == versions(once)


def test_check_history_compares_null_safely(spark):
    later = people(spark, [("1", "sao paulo", T2), ("2", None, T2), ("3", None, T2)])
    moment = F.lit(str(T3)).cast("timestamp_ntz")
    once = scd.by_check(first(spark), later, "customer_id", ["customer_city"], moment)
    assert versions(once) == sorted([
        ("1", "sao paulo", str(T1), "None"), ("2", "rio", str(T1), str(T3)), ("2", "", str(T3), "None"), ("3", "", str(T1), "None"),
    ])
    again = scd.by_check(once, later, "customer_id", ["customer_city"], moment)
    assert versions(again) == versions(once)


def test_duplicate_keys_are_rejected(spark):
    twice = people(spark, [("1", "a", T2), ("1", "b", T2)])
    with pytest.raises(ValueError, match="not unique"):
        scd.by_timestamp(first(spark), twice, "customer_id", "updated_at")


def test_null_keys_are_rejected_by_every_type(spark):
    bad = people(spark, [(None, "a", T2)])
    target = people(spark, [("1", "a", T1)])
    for run in (
        lambda: scd.by_timestamp(first(spark), bad, "customer_id", "updated_at"),
        lambda: scd.overwrite(target, bad, "customer_id"),
        lambda: scd.keep_previous(target, bad, "customer_id", "customer_city"),
        lambda: scd.insert_only(target, bad, "customer_id"),
    ):
        with pytest.raises(ValueError, match="NULL"):
            run()


def test_stored_history_over_four_runs(spark, tmp_path):
    """Runs: first, a change, the same again, another change; a cut-off run leaves no trace."""
    root = f"{tmp_path}/history"
    a, b = people(spark, [("1", "sao paulo", T1), ("2", "rio", T1)]), people(spark, [("1", "rio", T2), ("2", "rio", T1)])
    c = people(spark, [("1", "bahia", T3), ("2", "rio", T1), ("3", "x", T3)])

    def take(source):
        scd.take_snapshot(
            source, root, "customer_id", F.col("updated_at"),
            lambda opened: scd.by_timestamp(opened, source, "customer_id", "updated_at"),
        )
        return scd.read_history(spark, root, a.schema)

    plain = scd.first_snapshot(a, F.col("updated_at"))
    assert versions(take(a)) == versions(plain)
    plain = scd.by_timestamp(plain, b, "customer_id", "updated_at")
    assert versions(take(b)) == versions(plain) and versions(take(b)) == versions(plain)
    a.write.parquet(f"{root}/run=4/is_open=true")  # not published
    plain = scd.by_timestamp(plain, c, "customer_id", "updated_at")
    assert versions(take(c)) == versions(plain)


def test_unchanged_buckets_are_neither_read_nor_written(spark, tmp_path):
    root = f"{tmp_path}/history"
    rule = scd.timestamp_rule("customer_id", "updated_at")
    take = lambda source, by=rule: scd.snapshot(source, root, "customer_id", F.col("updated_at"), by)
    written = lambda run: sorted(p.parent.name for p in Path(root).glob(f"run={run}/is_open=true/*/*.parquet"))
    before = people(spark, [(str(i), "rio", T1) for i in range(300)])
    after = people(spark, [(str(i), "bahia" if i == 7 else "rio", T2 if i == 7 else T1) for i in range(300)])
    take(before)
    assert len(set(written(1))) == scd.MIN_BUCKETS
    take(after)
    changed = written(2)
    assert len(changed) == 1
    # Run 1's other buckets are still the open versions; one that is not opened cannot be missed.
    plain = scd.by_timestamp(scd.first_snapshot(before, F.col("updated_at")), after, "customer_id", "updated_at")
    assert versions(scd.read_history(spark, root, before.schema)) == versions(plain)
    take(after)
    assert not Path(f"{root}/run=3").exists()
    # A third state: the bucket of run 1 that run 2 replaced goes once run 3 is published.
    last = people(spark, [(str(i), "natal" if i == 7 else "rio", T3 if i == 7 else T1) for i in range(300)])
    take(last)
    assert written(3) == changed and changed[0] not in written(1) and len(set(written(1))) == scd.MIN_BUCKETS - 1
    plain = scd.by_timestamp(plain, last, "customer_id", "updated_at")
    assert versions(scd.read_history(spark, root, before.schema)) == versions(plain)
    # Another rule may see what this one passed over: every bucket is looked at.
    take(last, scd.check_rule("customer_id", ["customer_city"], F.lit(str(T3)).cast("timestamp_ntz")))
    assert len(set(written(4))) == scd.MIN_BUCKETS
    assert versions(scd.read_history(spark, root, before.schema)) == versions(plain)


def test_random_snapshots_equal_the_plain_history(spark, tmp_path, monkeypatch):
    """Keys come, go and come back, values swap with NULL, and buckets become too few."""
    monkeypatch.setattr(scd, "MIN_BUCKETS", 3)
    monkeypatch.setattr(scd, "BUCKET_ROWS", 4)
    rng, root = random.Random(3), f"{tmp_path}/history"
    schema = "customer_id string, customer_city string, customer_state string"
    rule = scd.check_rule("customer_id", ["customer_city", "customer_state"], F.lit(str(T2)).cast("timestamp_ntz"))
    state, plain, start = {}, None, F.lit(str(T1)).cast("timestamp_ntz")
    for size in (0, 5, 5, 8, 70, 70):
        for key in rng.sample(range(size), size // 3):
            state.pop(key, None)
        for key in rng.sample(range(size), size // 2):
            a, b = state.get(key, ("x", None))
            state[key] = (b, a) if rng.random() < 0.6 else (rng.choice("xyz"), None)
        source = spark.createDataFrame([(str(k), *v) for k, v in state.items()], schema)
        scd.snapshot(source, root, "customer_id", start, rule)
        if plain is None:
            plain = scd.first_snapshot(source, start)
        else:
            plain = scd.by_check(plain, source, "customer_id", ["customer_city", "customer_state"], F.lit(str(T2)).cast("timestamp_ntz"))
        rows = sorted(map(str, map(tuple, plain.collect())))
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        assert sorted(map(str, map(tuple, scd.read_history(spark, root, source.schema).collect()))) == rows
    twice = spark.createDataFrame([("1", "a", None), ("1", "b", None)], schema)
    with pytest.raises(ValueError, match="not unique"):
        scd.snapshot(twice, root, "customer_id", start, rule)


def test_point_in_time_equals_a_range_join(spark, request):
    """One key with most facts and very many versions, gaps, equal moments, repeated facts and NULLs."""
    rng = random.Random(8)
    day = lambda n: T1 + (T2 - T1) * n / 31
    history = []
    for key, n in (("hot", 400), ("a", 5), ("b", 1)):
        cuts = sorted(rng.sample(range(1200), n))
        for i, low in enumerate(cuts):
            high = cuts[i + 1] if i + 1 < n else None
            if high is not None and rng.random() < 0.2:
                high = rng.randrange(low, high + 1)  # a gap, or nothing covered
            history.append((key, rng.choice(["x", "y", None]), i, day(low), None if high is None else day(high)))
    history += [(None, "z", 0, day(0), None), ("c", "z", 0, None, None), ("a", "z", 9, day(3), day(3))]
    facts = [(rng.choice(["hot"] * 8 + ["a", "b", "c", "d", None]), day(rng.randrange(-5, 1210)), rng.randrange(3)) for _ in range(3000)]
    facts += [("hot", day(50), 1)] * 200 + [("hot", None, 1), ("a", day(3), 7)]
    h = spark.createDataFrame(history, f"customer_id string, city string, n int, {scd.VALID_FROM} timestamp_ntz, {scd.VALID_TO} timestamp_ntz")
    f = spark.createDataFrame(facts, "customer_id string, sold_at timestamp_ntz, amount int")
    h.createOrReplaceTempView("h")
    f.createOrReplaceTempView("f")
    want = spark.sql(f"""
        SELECT f.*, city, n FROM f LEFT JOIN h ON f.customer_id = h.customer_id AND sold_at >= {scd.VALID_FROM}
        AND ({scd.VALID_TO} IS NULL OR sold_at < {scd.VALID_TO})""")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    got = scd.point_in_time(f, h, "customer_id", "sold_at", ["city", "n"])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().toString()
    assert "BroadcastNestedLoopJoin" not in plan
    # The hot key lies in several slices: what is carried over comes from the slices before.
    placed = grouping.carried(
        f.filter("sold_at IS NOT NULL"), ["customer_id"], ["sold_at", "amount"], {"seen": F.when(F.col("amount") == 2, F.col("sold_at"))}
    )
    mine = sorted((r for r in placed.collect() if r["customer_id"] == "hot"), key=lambda r: (r["sold_at"], r["amount"]))
    last = None
    for r in mine:
        last = r["sold_at"] if r["amount"] == 2 else last
        assert r["seen"] == last
    sliced = grouping._sliced(f, ["customer_id"], [F.col("sold_at")])
    assert sliced.filter("customer_id = 'hot'").select("_slice").distinct().count() > 1


def test_checksums_tell_in_which_column_a_null_is(spark):
    rows = spark.createDataFrame([(1, "x", None), (2, None, "x")], "i int, a string, b string")
    one, two = (rows.filter(f"i = {i}").agg(hash_sum(["a", "b"])).first()[0] for i in (1, 2))
    assert one != two


def test_validity_is_half_open(spark):
    history = scd.by_timestamp(first(spark), people(spark, [("1", "rio", T2)]), "customer_id", "updated_at")
    facts = spark.createDataFrame([("1", T2), ("1", datetime(2026, 1, 31, 23)), ("1", datetime(2025, 1, 1)), ("9", T2)],
                                  "customer_id string, sold_at timestamp_ntz")
    got = scd.point_in_time(facts, history, "customer_id", "sold_at", ["customer_city"])
    assert sorted((r["customer_id"], str(r["sold_at"])[:10], r["customer_city"]) for r in got.collect()) == [
        ("1", "2025-01-01", None), ("1", "2026-01-31", "sao paulo"), ("1", "2026-02-01", "rio"), ("9", "2026-02-01", None)]


def test_type_3_keeps_the_last_change(spark):
    target = people(spark, [("1", "a", T1), ("2", "b", T1)])
    once = scd.keep_previous(target, people(spark, [("1", "c", T2), ("3", "d", T2)]), "customer_id", "customer_city")
    again = scd.keep_previous(once, people(spark, [("1", "c", T3)]), "customer_id", "customer_city")
    got = {r["customer_id"]: (r["customer_city"], r["prev_customer_city"]) for r in again.collect()}
    assert got == {"1": ("c", "a"), "2": ("b", None), "3": ("d", None)}


# --- quality -----------------------------------------------------------------


def test_suite_counts_like_the_single_rules(spark):
    child = spark.createDataFrame([("1", 5, "a"), ("1", -1, " "), ("2", None, None), (None, 300, "zzz"), ("4", 1, "a")],
                                  "id string, n int, label string")
    parent = spark.createDataFrame([("1",), ("2",)], "id string")
    rules = [
        Rule("child", "id", "unique"), Rule("child", "id", "not_null"),
        Rule("child", "id", "relationships", parent="parent", parent_key="id"),
        Rule("child", "n", "value_range", low=0, high=100), Rule("child", "n", "value_range", low=0),
        Rule("child", "label", "not_empty_string", severity="warn"),
        Rule("child", "label", "accepted_values", values=("a", " ")),
    ]
    report = quality.suite_report({"child": child, "parent": parent}, rules).collect()
    found = sorted((r["rule"], r["failures"], r["status"]) for r in report)
    assert found == sorted([
        ("unique", 1, "fail"), ("not_null", 1, "fail"), ("relationships", 1, "fail"), ("value_range", 2, "fail"),
        ("value_range", 1, "fail"), ("not_empty_string", 2, "warn"), ("accepted_values", 1, "fail"),
    ])


def test_suite_makes_no_column_that_cannot_be_null(spark):
    """A numbering for the sake of a rule that it cannot break would shuffle all lines."""
    lines = grouping.numbered(spark.createDataFrame([("o", 2), ("o", 1)], "order_id string, x int"), ["order_id"], [F.col("x")], row="n")
    rules = [Rule("t", "n", "not_null"), Rule("t", "x", "not_null")]
    report = quality.suite_report({"t": lines}, rules)
    assert "row_number" not in report._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["column_name"], r["failures"], r["status"]) for r in report.orderBy("column_name").collect()] == [("n", 0, "pass"), ("x", 0, "pass")]


def test_warnings_do_not_block_publishing(spark):
    df = spark.createDataFrame([(None,)], "x string")
    assert quality.may_publish(quality.suite_report({"t": df}, [Rule("t", "x", "not_null", severity="warn")]))
    assert not quality.may_publish(quality.suite_report({"t": df}, [Rule("t", "x", "not_null")]))


def test_all_rules_are_declared():
    kinds = [r.kind for r in quality.RULES]
    assert len(kinds) == 84
    assert {k: kinds.count(k) for k in ("not_null", "unique", "accepted_values", "relationships", "value_range")} == {
        "not_null": 42, "unique": 18, "accepted_values": 12, "relationships": 6, "value_range": 3}


def test_publishing_switches_versions(spark, tmp_path):
    assert tables.published(spark, f"{tmp_path}/root", spark.createDataFrame([("a",)], "x string").schema).count() == 0
    for version, rows in (("1", [("a",)]), ("2", [("b",), ("c",)])):
        df = tables.write_table(spark.createDataFrame(rows, "x string"), f"{tmp_path}/v{version}")
        tables.publish(spark, f"{tmp_path}/root", f"{tmp_path}/v{version}")
        assert tables.published(spark, f"{tmp_path}/root", df.schema).count() == len(rows)


# --- CSV ---------------------------------------------------------------------


def test_raw_csv_keeps_zeros_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "x_order_reviews_dataset.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"line one\nsaid ""hi"", ok",2018-01-01 00:00:00,2018-01-02 10:00:00\n'
        "r2,o2,4,,,2018-01-03 00:00:00,\n"
    )
    rows = staging.stg_order_reviews(csv_files.load_raw(spark, str(tmp_path), "order_reviews")).orderBy("review_id").collect()
    assert rows[0]["review_comment_message"] == 'line one\nsaid "hi", ok'
    assert (rows[1]["review_comment_message"], rows[1]["review_answered_at"], rows[0]["review_key"]) == (None, None, "r1-o1")


def test_old_column_names_are_aligned_on_load(spark, tmp_path):
    (tmp_path / "x_customers_dataset.csv").write_text(
        "customer_id,customer_unique_id,customer_zip_code,customer_city,customer_state\n1,u,01151, Sao Paulo ,sp\n")
    row = staging.stg_customers(csv_files.load_raw(spark, str(tmp_path), "customers")).first()
    assert (row["customer_zip_code"], row["customer_city"], row["customer_state"]) == ("01151", "sao paulo", "SP")


def test_columns_are_taken_by_name_and_must_be_there(spark, tmp_path):
    head = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state"
    folder = tmp_path / "x_customers_dataset.csv"
    folder.mkdir()
    (folder / "part-1.csv").write_text(f"{head}\n1,u,01000,sp,SP\n")
    assert csv_files.load_raw(spark, str(tmp_path), "customers").count() == 1
    (tmp_path / "y_customers_dataset.csv").write_text("extra,customer_state,customer_id,customer_city,customer_zip_code,customer_unique_id\n?,RJ,2,rio,02000,v\n")
    got = sorted(map(tuple, csv_files.load_raw(spark, str(tmp_path), "customers").collect()))
    assert got == [("1", "u", "01000", "sp", "SP"), ("2", "v", "02000", "rio", "RJ")]
    assert csv_files.load_raw(spark, str(tmp_path), "customers", prefix="y_").count() == 1
    (folder / "part-2.csv").write_text("customer_unique_id,customer_id,customer_zip_code_prefix,customer_city,customer_state\nu,1,01000,sp,SP\n")
    with pytest.raises(Exception, match="header"):
        csv_files.load_raw(spark, str(tmp_path), "customers", prefix="x_").collect()
    (tmp_path / "z_customers_dataset.csv").write_text("customer_id,customer_city\n3,x\n")
    with pytest.raises(ValueError, match="lacks customer_unique_id"):
        csv_files.load_raw(spark, str(tmp_path), "customers", prefix="z_")


def test_many_deliveries_are_one_read_for_each_header(spark, tmp_path):
    contract = CONTRACTS["customers"]
    turned = list(reversed(contract.columns))
    for i in range(30):
        names = turned if i % 3 == 0 else contract.columns
        with open(tmp_path / contract.file.replace("*", f"d{i}"), "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(names)
            writer.writerow([f"{i}-{c}" for c in names])
    paths = csv_files.matching(spark, f"{tmp_path}/{contract.file}")
    assert len(paths) == 30 and sorted(map(len, csv_files.by_header(spark, paths))) == [10, 20]
    got = csv_files.load_raw(spark, str(tmp_path), "customers")
    assert sorted(map(tuple, got.collect())) == sorted(tuple(f"{i}-{c}" for c in contract.columns) for i in range(30))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation ") == 2
    assert csv_files.first_line(spark, str(tmp_path)) is None


def test_present_contract_name_wins_over_the_old_one(spark):
    df = spark.createDataFrame([("a", "b")], "product_category string, product_category_name string")
    assert csv_files.align_columns(df, {"product_category": "product_category_name"}).columns == df.columns


def test_missing_files_are_empty_only_where_optional(spark, tmp_path):
    assert csv_files.load_raw(spark, str(tmp_path), "sellers").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_files.load_raw(spark, str(tmp_path), "orders")


def test_export_keeps_blanks_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 1.5), ('say "hi", ok', None), (None, 2.0)], "s string, x double")
    csv_files.export_csv(df, f"{tmp_path}/out")
    assert sorted(csv_files.read_export(spark, f"{tmp_path}/out", df.schema).collect(), key=repr) == sorted(df.collect(), key=repr)


def test_kpi_texts_are_sixteen():
    assert [t[0] for t in V.KPI_TEXTS] == [f"KPI{i:03}" for i in range(1, 17)]


def test_release_keeps_the_version_before_if_a_rule_fails(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    inputs = {name: getattr(driver_tables, name)(spark, sf) for name in CONTRACTS}
    root = f"{tmp_path}/warehouse"
    assert warehouse.released(spark, root) == {}
    report, passed = warehouse.release(spark, inputs, root)
    assert passed and report.filter("status = 'warn'").count() == 1
    payments = warehouse.released(spark, root)["fct_payments"].count()
    twice = {**inputs, "order_payments": inputs["order_payments"].unionByName(inputs["order_payments"])}
    report, passed = warehouse.release(spark, twice, root)
    assert not passed and report.filter("status = 'fail'").first()["failures"] > 0
    assert warehouse.released(spark, root)["fct_payments"].count() == payments


def test_build_stores_wanted_tables_and_what_they_read(spark, tmp_path):
    assert warehouse.with_inputs(["ads_payment_analysis"]) == {"ads_payment_analysis", "fct_payments"}
    assert warehouse.with_inputs(["ads_kpi_summary"]) >= {"dws_seller_performance", "dim_sellers", "fct_orders"}
    assert warehouse.with_inputs(warehouse.STORED) == set(warehouse.STORED)
    with pytest.raises(ValueError, match="no stored table"):
        warehouse.with_inputs(["stg_orders"])
    inputs = {name: getattr(driver_tables, name)(spark, "/root/testdata/sf0.001") for name in CONTRACTS}
    built = warehouse.build(spark, inputs, f"{tmp_path}/some", wanted=["ads_payment_analysis"])
    assert {p.name for p in (tmp_path / "some").iterdir()} == {"ads_payment_analysis", "fct_payments"}
    assert {name for name in built if not name.startswith("stg_")} == {"ads_payment_analysis", "fct_payments"}
    assert "some/fct_payments" in built["fct_payments"].inputFiles()[0]
    assert built["ads_payment_analysis"].count() > 0


def test_build_fails_where_a_table_does(spark, tmp_path):
    inputs = {name: getattr(driver_tables, name)(spark, "/root/testdata/sf0.001") for name in CONTRACTS}
    broken = F.raise_error(F.lit("no such order")).cast("string")
    inputs["order_payments"] = inputs["order_payments"].withColumn("payment_type", broken)
    with pytest.raises(Exception, match="no such order"):
        warehouse.build(spark, inputs, f"{tmp_path}/broken", wanted=["ads_payment_analysis", "dim_sellers"])
    assert not (tmp_path / "broken/ads_payment_analysis").exists()


def test_scratch_leaves_nothing_but_the_result(spark, tmp_path):
    here = Path(work_path(spark, "x").removeprefix("file:")).parent
    before = set(here.glob("*"))
    with scratch(spark):
        QUERIES["fct_reviews"](spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/result")
        assert set(here.glob("*")) > before
    assert set(here.glob("*")) == before and spark.read.parquet(f"{tmp_path}/result").count() > 0


@pytest.fixture()
def deliver(spark, tmp_path):
    """Deliver rows to a stream as one file; the table as it is then."""

    def run(rows, checkpoint="c"):
        df = fact(spark, rows)
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
        order_feed.merge_into(order_feed.line_stream(spark, f"{tmp_path}/feed", df.schema), f"{tmp_path}/t", f"{tmp_path}/{checkpoint}")
        return content(tables.read_table(spark, f"{tmp_path}/t", df.schema))

    return run


def test_stream_keeps_lines_in_state_that_can_be_asked_for(spark, tmp_path, deliver):
    """A first load of years feeds its last days to the state, keys and hashes alone; an old version that comes again is known."""

    def asked(batch):
        rows = spark.read.parquet(f"{tmp_path}/c/lines/feed/batch={batch}")
        assert "order_amount" not in rows.columns
        return sorted(r["order_item_key"] for r in rows.collect())

    years = [(f"y{i}", date(2010 + i, 5, 5), i) for i in range(8)]
    last = [("p", date(2018, 3, 13), 1), ("q", date(2018, 3, 14), 1), ("r", date(2018, 3, 20), 1)]
    assert deliver([*years, *last]) == content(fact(spark, [*years, *last]))
    assert asked(0) == ["q", "r"]
    # Newer than all before and behind the next mark: merged, and in no state.
    newer = [("q", date(2018, 3, 14), 2), ("s", date(2018, 3, 25), 1), ("t", date(2018, 4, 5), 1)]
    assert deliver(newer) == content(fact(spark, [*years, last[0], last[2], *newer]))
    assert asked(1) == ["q", "t"]
    assert not Path(f"{tmp_path}/c/lines/feed/batch=0").exists()
    # Unchanged within the lateness it is a repetition; behind the mark it is late and merged.
    assert deliver([newer[2], ("t", date(2018, 4, 5), 2)]) == content(fact(spark, [*years, last[0], last[2], *newer[:2], ("t", date(2018, 4, 5), 2)]))
    assert deliver([newer[2]]) == content(fact(spark, [*years, last[0], last[2], *newer[:2], ("t", date(2018, 4, 5), 2)]))
    assert ("q", "2018-03-14", D("1.00")) in deliver([last[1]])


def test_stream_leaves_adds_or_writes_months(spark, tmp_path, deliver):
    """By the names of the files: January comes again, February gets a new line and March another version."""

    def files():
        return {(f.rsplit("/", 2)[1][12:19], f.rsplit("/", 1)[1]) for f in spark.read.schema(FACT).parquet(f"{tmp_path}/t").inputFiles()}

    deliver([*OLD, ("u", None, 1)])
    before = files()
    state = [OLD[0], OLD[1], ("b2", date(2018, 2, 21), 5), ("c", date(2018, 3, 10), 30), ("u", None, 1), ("n", date(2018, 4, 1), 6)]
    assert deliver([OLD[0], *state[2:]]) == content(fact(spark, state))
    assert sorted(month for month, _ in before & files()) == ["2018-01", "2018-02", "__HIVE_"]
    assert sorted(month for month, _ in files() - before) == ["2018-02", "2018-03", "2018-04"]


def test_stream_writes_a_month_of_many_files_again(spark, tmp_path, deliver, monkeypatch):
    monkeypatch.setattr(incremental, "MONTH_FILES", 2)
    state = []
    for i in range(4):
        state.append((f"k{i}", date(2018, 2, 20 + i), i))
        assert deliver(state[-1:]) == content(fact(spark, state))
        assert len(spark.read.schema(FACT).parquet(f"{tmp_path}/t").inputFiles()) == [1, 2, 1, 2][i]


def test_stream_settles_a_key_of_two_months_and_parts_of_months(spark, deliver, monkeypatch):
    monkeypatch.setattr(incremental, "PART_ROWS", 2)
    rows = [(f"k{i}", date(2018, 2, 1 + i), i) for i in range(9)] + [(f"u{i}", None, i) for i in range(5)]
    twice = [("k0", date(2018, 3, 1), 7), ("k8", date(2018, 2, 9), 9), ("k8", date(2018, 2, 9), 8)]
    wanted = [*rows[1:8], *rows[9:], ("k0", date(2018, 3, 1), 7), ("k8", date(2018, 2, 9), 9)]
    assert deliver([*rows, *twice, *twice]) == content(fact(spark, wanted))


def test_stream_batch_that_is_replayed_loses_nothing(spark, tmp_path, deliver, monkeypatch):
    """Cut off behind the state, and between the commit of a merge and its files."""
    deliver(OLD)
    second = [("c", date(2018, 3, 10), 3), ("d", date(2018, 3, 12), 4), ("e", date(2017, 1, 1), 5)]
    with monkeypatch.context() as m:
        m.setattr(order_feed, "merge", lambda *a, **k: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(Exception, match="cut off"):
            deliver(second)
    with monkeypatch.context() as m:
        m.setattr(incremental, "add_files", lambda *a: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(Exception, match="cut off"):
            deliver([("d", date(2018, 3, 12), 4)])
    assert deliver([("f", date(2018, 3, 13), 6)]) == content(fact(spark, [*OLD, *second[1:], ("f", date(2018, 3, 13), 6)]))
    late = order_feed.late_lines(spark, f"{tmp_path}/t", fact(spark, []).schema)
    assert content(late) == content(fact(spark, second[2:]))
