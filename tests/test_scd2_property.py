"""SCD2 standard merge vs a brute-force model, on random small batches."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medalake import schemas
from medalake.operators import scd2 as S
from medalake.plans.specs import SPECS

SPEC = SPECS["customers"]
U = dt.datetime(2024, 1, 1)
TIMES = [dt.datetime(2024, 6, 1), dt.datetime(2024, 7, 1), dt.datetime(2024, 8, 1)]

row = st.tuples(st.sampled_from([1, 2, 3, 4, None]), st.sampled_from(["a", "b", None]),
                st.sampled_from(["x", None]), st.sampled_from([U, U + dt.timedelta(days=1), None]))
batches = st.lists(st.lists(row, max_size=6), min_size=1, max_size=3)


def _sort_key(v):
    return (v is not None, v)


def model(batch_list):
    table = []   # rows as tuples in silver column order
    for as_of, batch in zip(TIMES, batch_list):
        latest = {}
        for k, name, email, upd in batch:
            if k is None:
                continue
            cand = (upd, name, email)
            cur = latest.get(k)
            if cur is None or tuple(map(_sort_key, cand)) > tuple(map(_sort_key, cur)):
                latest[k] = cand
        active = {r[0]: r for r in table if r[7]}
        out = [r for r in table if not r[7]]
        for k in set(active) | set(latest):
            old = active.get(k)
            new = latest.get(k)
            if new is not None:
                upd, name, email = new
                new_row = (k, name, email, upd, email is None or name is None, as_of, None, True)
            late = (old is not None and new is not None and upd is not None and old[3] is not None
                    and upd < old[3])
            if old is not None and new is not None and not late and (old[1], old[2], old[3]) != (name, email, upd):
                out.append(old[:6] + (as_of, False))
                out.append(new_row)
            elif old is not None:
                out.append(old)
            else:
                out.append(new_row)
        table = out
    return sorted(table, key=lambda r: tuple(map(_sort_key, r)))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches)
def test_standard_merge_matches_model(spark, batch_list):
    cur = None
    for as_of, batch in zip(TIMES, batch_list):
        inc = spark.createDataFrame(batch, schemas.SOURCE["customers"])
        cur = S.scd2_merge(cur, inc, SPEC, as_of).table
    got = sorted((tuple(r) for r in cur.collect()), key=lambda r: tuple(map(_sort_key, r)))
    assert got == model(batch_list)
