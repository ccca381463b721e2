"""The mart in a database, with stand-ins for the server and for the JDBC edge."""

import copy
import re
from collections import Counter

import pytest

from checks.adapters import ADAPTERS, source_tables
from granero.plans import broker
from granero.plans.load import load_mart
from granero.sinks import database
from granero.sinks.database import DatabaseMart
from granero.sinks.mart import ParquetMart
from granero.sinks.targets import COBERTURA, CORREDOR, PRODUCTO, PRODUCTO_COBERTURA, TARGETS
from granero.sources.jdbc import balanced_scan, cuts_query, share_predicates
from granero.sources.snapshots import SnapshotStore
from tests.helpers import bag

BY_NAME = {target.name: target for target in TARGETS}


class Server:
    """Tables as lists of rows; knows only the statements that the mart writes."""

    def __init__(self):
        self.tables = {target.name: [] for target in TARGETS}
        self.ledger, self.log, self.fail_at = {}, [], None

    def query(self, statement):
        if found := re.fullmatch(r"SELECT COUNT\(DISTINCT row_no\) FROM (\w+)", statement):
            return [(len({row[-1] for row in self.tables[found[1]]}),)]
        found = re.fullmatch(r"SELECT row_count FROM load_ledger WHERE load_id = '(.*)' AND target = '(\w+)'", statement)
        return [(self.ledger[found.groups()],)] if found.groups() in self.ledger else []

    def transact(self, statements):
        before = copy.copy(self.ledger), {name: list(rows) for name, rows in self.tables.items()}
        try:
            for place, statement in enumerate(statements):
                self.run(statement)
                if self.fail_at == (statement.split()[0], place):
                    raise ConnectionError("lost")
        except Exception:
            self.ledger, self.tables = before
            raise

    def run(self, statement):
        self.log.append(statement)
        if found := re.fullmatch(r"INSERT INTO load_ledger .* VALUES \('(.*)', '(\w+)', (\d+)\)", statement):
            assert found.groups()[:2] not in self.ledger, "duplicate key"
            self.ledger[found.groups()[:2]] = int(found[3])
        elif found := re.fullmatch(r"DROP TABLE (\w+)", statement):
            del self.tables[found[1]]
        else:
            found = re.fullmatch(
                r"INSERT INTO (\w+) \((.*)\) SELECT (.*) FROM \(SELECT DISTINCT row_no, (.*) FROM (\w+)\) d( ON DUPLICATE KEY .*)?",
                statement,
            )
            target = BY_NAME[found[1]]
            assert found[2] == found[3] == found[4] == ", ".join(target.columns)
            rows = [row[:-1] for row in set(self.tables[found[5]])]
            if found[6]:
                held = {row[:2]: row for row in self.tables[target.name]} | {row[:2]: row for row in rows}
                self.tables[target.name] = list(held.values())
            else:
                self.add(target, rows)

    def add(self, target, rows):
        """The database numbers the rows in the mart's order."""
        if target.generated:
            places = [target.columns.index(field.name) for field in target.fields if field.source]
            rows = sorted(rows, key=lambda row: [(row[i] is not None, row[i]) for i in places])
            first = len(self.tables[target.name]) + 1
            rows = [(*row, first + i) for i, row in enumerate(rows)]
        self.tables[target.name] += rows


class StandIn(DatabaseMart):
    """Rows go to and come from the server's lists; some tasks write twice."""

    def _copy(self, rows, staging):
        taken = [tuple(row) for row in rows.collect()]
        assert rows.columns[-1] == "row_no"
        self.server.tables[staging] = taken + taken[: len(taken) // 3]

    def read(self, target):
        return self.spark.createDataFrame(self.server.tables[target.name], target.schema)


@pytest.fixture
def server():
    return Server()


@pytest.fixture
def mart(spark, server):
    return StandIn(spark, "jdbc:none", server)


def texts(spark, *names):
    return spark.createDataFrame([(None, 1, name) for name in names], COBERTURA.schema)


def test_a_load_moves_every_row_once_and_notes_it(spark, mart, server):
    mart.append(COBERTURA, texts(spark, "a", "a", "b"), "monday")
    assert Counter(row[2] for row in server.tables["Cobertura"]) == {"a": 2, "b": 1}
    assert server.ledger == {("monday", "Cobertura"): 3} and mart.has(COBERTURA, "monday")
    assert not mart.has(COBERTURA, "tuesday") and not mart.has(CORREDOR, "monday")
    assert set(server.tables) == set(BY_NAME)  # the staging table is gone


def test_a_repeated_load_id_changes_nothing(spark, mart, server):
    mart.append(COBERTURA, texts(spark, "a"), "monday")
    before = copy.deepcopy((server.tables, server.ledger, server.log))
    mart.append(COBERTURA, texts(spark, "other"), "monday")
    assert (server.tables, server.ledger, server.log) == before
    mart.append(COBERTURA, texts(spark, "other"))
    assert len(server.tables["Cobertura"]) == 2


@pytest.mark.parametrize("place", [0, 1])
def test_a_failed_transaction_leaves_neither_rows_nor_note(spark, mart, server, place):
    server.fail_at = ("INSERT", place)
    with pytest.raises(ConnectionError):
        mart.append(COBERTURA, texts(spark, "a", "b"), "monday")
    assert server.tables["Cobertura"] == [] and server.ledger == {}
    server.fail_at = None
    mart.append(COBERTURA, texts(spark, "a", "b"), "monday")
    assert len(server.tables["Cobertura"]) == 2


def test_a_load_that_another_one_overtook_changes_nothing(spark, mart, server):
    move = server.transact

    def overtaken(statements):
        server.ledger[("monday", "Cobertura")] = 1
        server.transact = move
        move(statements)

    server.transact = overtaken
    mart.append(COBERTURA, texts(spark, "a"), "monday")
    assert server.tables["Cobertura"] == []


def test_missing_rows_stop_the_load(spark, mart, server, monkeypatch):
    monkeypatch.setattr(mart, "_copy", lambda rows, staging: server.tables.update({staging: []}))
    with pytest.raises(RuntimeError, match="0 of 1 rows"):
        mart.append(COBERTURA, texts(spark, "a"), "monday")
    assert server.ledger == {}


def test_upserts(spark, mart, server):
    mart.upsert(CORREDOR, spark.createDataFrame([(1, 1, 5, "A"), (1, 1, 6, "B"), (2, 2, 0, None)], CORREDOR.schema), "one")
    mart.upsert(CORREDOR, spark.createDataFrame([(2, 2, 1, "C")], CORREDOR.schema), "two")
    assert sorted(server.tables["Corredor"]) == [(1, 1, 6, "B"), (2, 2, 1, "C")]
    merge = StandIn(spark, "jdbc:none", server, dialect="merge")
    with pytest.raises(TypeError):  # the stand-in does not know this statement
        merge.upsert(CORREDOR, spark.createDataFrame([(3, 3, 1, "D")], CORREDOR.schema), "three")
    assert server.log[-1].startswith("MERGE INTO Corredor t USING (SELECT DISTINCT row_no, ") and ") s ON t." in server.log[-1]
    assert len(server.tables["Corredor"]) == 2


def test_staging_names_and_load_ids(mart):
    names = {database.staging_name(load, target) for load in ("a", "b") for target in TARGETS}
    assert len(names) == 2 * len(TARGETS)
    assert all(re.fullmatch(r"[A-Za-z]+_[0-9a-f]{16}", name) for name in names)
    for bad in ("", "x'; --", "a b", "x" * 65):
        with pytest.raises(ValueError):
            mart.has(COBERTURA, bad)
    assert "PRIMARY KEY (load_id, target)" in database.ledger_table()


# --- whole loads ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def tables(spark):
    lazy = source_tables(spark, "/root/testdata/sf0.001")
    return {name: lazy[name] for name in ADAPTERS}


def test_a_whole_load_equals_the_parquet_mart(spark, base, tables, mart, server):
    plain = ParquetMart(spark, base + "/mart")
    load_mart(tables, plain, batch_id="one")
    load_mart(tables, mart, batch_id="one")
    for target in TARGETS:
        assert bag(mart.read(target)) == bag(plain.read(target))
    before = copy.deepcopy(server.tables)
    load_mart(tables, mart, batch_id="one")
    assert server.tables == before


@pytest.mark.parametrize("kind", ["parquet", "database"])
def test_a_failed_load_goes_on_after_its_last_step(spark, base, tables, mart, monkeypatch, kind):
    mart = mart if kind == "database" else ParquetMart(spark, base + "/mart")
    snapshots = SnapshotStore(spark, base + "/snapshots")
    real = broker.producto_corredor_load

    def broken(*_):
        raise RuntimeError("executors lost")

    monkeypatch.setattr(broker, "producto_corredor_load", broken)
    with pytest.raises(RuntimeError):
        load_mart(tables, mart, snapshots, resume=True)
    batch = snapshots.identity(list(tables))
    assert [mart.has(target, batch) for target in TARGETS] == [True, True, True, True, False]
    monkeypatch.setattr(broker, "producto_corredor_load", real)

    steps = []
    for name in ("append", "upsert"):
        write = getattr(mart, name)
        monkeypatch.setattr(mart, name, lambda target, *rest, write=write: (steps.append(target.name), write(target, *rest)))
    load_mart(tables, mart, snapshots, resume=True)
    assert steps == ["ProductoCorredor"]
    load_mart(tables, mart, snapshots, resume=True)
    assert steps == ["ProductoCorredor"]

    whole = ParquetMart(spark, base + "/whole")
    load_mart(tables, whole)
    for target in TARGETS:
        assert bag(mart.read(target)) == bag(whole.read(target))
    if kind == "parquet":  # newer snapshots are a load of their own
        snapshots.take(tables, "new")
        assert snapshots.identity(list(tables)) != batch


def test_only_named_loads_resume(spark, base, tables):
    with pytest.raises(ValueError, match="resumed"):
        load_mart(tables, ParquetMart(spark, base), resume=True)


# --- balanced reads -------------------------------------------------------------------


def ntile_cuts(ids, shares):
    """What ``cuts_query`` returns: the first value of each share of the ordered ones."""
    ids = sorted(i for i in ids if i is not None)
    size, extra = divmod(len(ids), shares)
    cuts, at = [], 0
    for share in range(min(shares, len(ids))):
        cuts.append(ids[at])
        at += size + (share < extra)
    return cuts


@pytest.mark.parametrize("ids", [
    list(range(1, 101)) + [10**9 + i * i for i in range(700)] + [None] * 3,
    [5] * 40 + list(range(100)),
    [None, None], [], [7],
])
def test_shares_are_even_and_hold_every_row_once(spark, ids):
    table = spark.createDataFrame([(i,) for i in ids], "id bigint")
    conditions = share_predicates("id", ntile_cuts(ids, 8))
    held = [table.where(condition).count() for condition in conditions]
    assert sum(held) == len(ids)
    if len(ids) > 200:
        assert len(held) == 8 and max(held) - min(held) <= 1 + ids.count(None)
        step = (max(i for i in ids if i) + 1) // 8  # equal steps leave nearly all to two readers
        assert table.where(f"id < {step}").count() == 100


def test_a_balanced_read_asks_for_its_cuts_first(monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def option(self, name, value):
            seen[name] = value
            return self

        def load(self):
            return self

        def collect(self):
            return [(50,), (1,), (900,)]

        def jdbc(self, url, table, predicates, properties):
            return url, table, predicates, properties

    class Session:
        read = Reader()

    found = balanced_scan(Session, "jdbc:none", "Producto", "ProductoId", 3, {"user": "u"})
    assert seen == {"url": "jdbc:none", "user": "u", "query": cuts_query("Producto", "ProductoId", 3)}
    assert found == ("jdbc:none", "Producto", ["ProductoId < 50 OR ProductoId IS NULL", "ProductoId >= 50 AND ProductoId < 900", "ProductoId >= 900"], {"user": "u"})


def test_products_are_read_in_even_shares_and_others_plainly(spark, server, monkeypatch):
    monkeypatch.setattr(database, "balanced_scan", lambda *args: args[2:5])
    monkeypatch.setattr(database, "plain_scan", lambda *args: args[2])
    mart = DatabaseMart(spark, "jdbc:none", server, connections=3)
    assert mart.read(PRODUCTO) == ("Producto", "ProductoId", 3)
    assert mart.read(PRODUCTO_COBERTURA) == "ProductoCobertura"
