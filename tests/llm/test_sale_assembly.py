import datetime as dt
import math
import zlib
from collections import Counter, defaultdict

import pytest

from lodestack.llm import queries
from lodestack.llm import sale_assembly as A

SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int, day int, due long, head string"
LINES = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz, day int, cents long, group string"


def cents(x):
    return 0 if x is None or not math.isfinite(x) or abs(x * 100) >= 2**53 else math.floor(100 * x + 0.5)


def day(t):
    return (t - dt.datetime(1970, 1, 1)).days


def plain(sales, lines, batches=12):
    """The contract, day by day, sale by sale."""
    came, of_sale = defaultdict(lambda: defaultdict(list)), defaultdict(list)
    for r in {tuple(r[:9]) for r in lines if r[0] is not None}:
        h = zlib.crc32(f"{r[0]}:{'' if r[1] is None else r[1]}".encode())
        d = 19723 + h % 152 if r[8] is None else day(r[8]) + h % 4
        of_sale[r[0]].append((d, cents(r[5])))
        came[d][r[0]].append(("line", cents(r[5])))
    for r in sales:
        if r[0] is not None:
            own, kind = of_sale[r[0]], zlib.crc32(str(r[0]).encode()) % 5
            latest = max((d for d, _ in own), default=None)
            due = cents(r[3]) if kind == 0 else sum(c for d, c in own if kind != 1 or d < latest)
            came[19723 if r[5] is None else day(r[5])][r[0]].append(("head", due))
    batch_of = lambda d: min(max((d - 19723) * batches // 160, 0), batches - 1)
    held, out, largest = {}, [], None
    close = lambda s, status, k: out.append((s, *held[s][:4], held[s][4], status, k)) or held.pop(s)
    for k in range(batches):
        for d in sorted(d for d in came if batch_of(d) == k):
            for s, parts in came[d].items():
                first, _, n, total, due = held.get(s, (d, d, 0, 0, None))
                own = [x for kind, x in parts if kind == "line"]
                dues = [x for kind, x in parts if kind == "head"] + ([] if due is None else [due])
                held[s] = first, d, n + len(own), total + sum(own), max(dues, default=None)
                if dues and held[s][2] and held[s][3] == held[s][4]:
                    close(s, "complete", k)
        for s in list(held):
            if k == batches - 1 or largest is not None and held[s][0] + 20 <= largest:
                _, _, n, total, due = held[s]
                close(s, "headless" if due is None else "orphan" if not n else "short" if total < due else "over", k)
        largest = max([d for d in came if batch_of(d) == k] + ([] if largest is None else [largest]), default=None)
    return Counter(out)


def rows_of(df):
    return Counter(tuple(r) for r in df.select("sale_id", "first_day", "last_day", "n_lines", "cents", "due", "status", "closing_batch").collect())


def test_whole_tables(spark, data):
    sales, lines = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("sales", "sale_lines"))
    found = queries.op13_sale_assembly(spark, data)
    assert dict(found.dtypes) == dict(sale_id="bigint", first_day="int", last_day="int", n_lines="bigint", cents="bigint", due="bigint", status="string", closing_batch="int")
    wanted = plain([tuple(r) for r in sales.collect()], [tuple(r) for r in lines.collect()])
    assert rows_of(found) == wanted
    assert {r[6] for r in wanted} == {"complete", "headless", "orphan", "short", "over"}


@pytest.fixture(scope="module")
def odd():
    at = lambda d: dt.datetime(1970, 1, 1) + dt.timedelta(days=d, hours=7)
    sales = [(k, 1, "done", [12.5, None, float("nan"), 1e300, 3.0][k % 5], None, None if k % 7 == 6 else at(19723 + 11 * k), 1, 3, 4, "x") for k in range(12)]
    sales += [sales[3], (4, 1, "open", 99.0, None, at(19760), 1, 3, 4, "x"), (None, 1, "x", 1.0, None, at(19730), 1, 3, 4, "x"), (-1, 1, "x", 1.0, None, at(-300), 1, 3, 4, "x"), (600, 1, "x", 2.0, None, at(90000), 1, 3, 4, "x")]
    lines = [(k % 13, [k % 3, None][k % 5 == 4], 1, 1, 1, [2.5, None, 10.0, float("inf"), 0.0][k % 5], 0.1, "f", [at(19723 + k * 5), None][k % 6 == 5], 9, 9, "x") for k in range(45)]
    lines += [lines[2], lines[2], (None, 1, 1, 1, 1, 1.0, 0.1, None, at(19800), 9, 9, "x"), (-1, 1, 1, 1, 1, 1.0, 0.1, None, at(-200), 9, 9, "x"), (600, 1, 1, 1, 1, 2.0, 0.1, None, at(90003), 9, 9, "x")]
    return sales, lines


@pytest.mark.parametrize("per_group", [A.SALES, 1])
def test_odd_rows(spark, odd, per_group):
    sales, lines = odd
    found = A.assemble(spark.createDataFrame(sales, SALES), spark.createDataFrame(lines, LINES).repartition(3), batches=5, sales_per_group=per_group)
    assert rows_of(found) == plain(sales, lines, 5)


def test_empty_batches_and_tables(spark, odd):
    sales, lines = odd
    few = [r for r in lines if r[0] == 5][:2]
    assert rows_of(A.assemble(spark.createDataFrame([], SALES), spark.createDataFrame(few, LINES), batches=4)) == plain([], few, 4)
    assert A.assemble(spark.createDataFrame([], SALES), spark.createDataFrame([], LINES), batches=2).count() == 0
