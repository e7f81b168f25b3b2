"""Messages cross between this pipeline and plain-Python producers and
consumers (``json.dumps`` / ``json.loads``, UTF-8) without changing a field,
whatever the text holds: quotes, backslashes, control characters, non-ASCII
and missing (null) fields."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import encode_messages, parse_messages
from tessera.schemas import MESSAGE_FIELDS

TEXT = st.one_of(st.none(), st.text(max_size=40))
TICKET = st.fixed_dictionaries({name: TEXT for name in MESSAGE_FIELDS})
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
SCHEMA = "i int, " + ", ".join(f"{name} string" for name in MESSAGE_FIELDS)


@SETTINGS
@given(tickets=st.lists(TICKET, min_size=1, max_size=25))
def test_python_produced_messages_parse_unchanged(spark, tickets):
    # as a Python producer sends them: json.dumps (ASCII escapes) then UTF-8
    rows = [(i, bytearray(json.dumps(t).encode("utf-8"))) for i, t in enumerate(tickets)]
    parsed = parse_messages(spark.createDataFrame(rows, "i int, value binary"), keep=["i"]).collect()
    got = {r.i: {name: getattr(r, name) for name in MESSAGE_FIELDS} for r in parsed}
    assert got == dict(enumerate(tickets))


@SETTINGS
@given(tickets=st.lists(TICKET, min_size=1, max_size=25))
def test_encoded_messages_decode_in_python(spark, tickets):
    rows = [(i, *[t[name] for name in MESSAGE_FIELDS]) for i, t in enumerate(tickets)]
    df = spark.createDataFrame(rows, SCHEMA)
    encoded = encode_messages(df, key="i").collect()
    decoded = {int(r.key.decode("utf-8")): json.loads(r.value.decode("utf-8")) for r in encoded}
    # null fields are left out of the object; a consumer reads them as absent
    assert decoded == {i: {k: v for k, v in t.items() if v is not None} for i, t in enumerate(tickets)}


CSV_TEXT = st.one_of(st.none(), st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=30).filter(lambda t: t != "\\N"))


@SETTINGS
@given(values=st.lists(CSV_TEXT, min_size=1, max_size=25))
def test_csv_dialect_round_trips_any_text(spark, values):
    import tempfile

    from tessera.sinks import read_csv, write_csv

    rows = [(str(i), v) for i, v in enumerate(values)]
    path = tempfile.mkdtemp(prefix="tessera-csv-")
    write_csv(spark.createDataFrame(rows, "ticket_id string, request string"), f"{path}/out")
    back = read_csv(spark, f"{path}/out", "ticket_id string, request string").collect()
    assert sorted((r.ticket_id, r.request) for r in back) == sorted(rows)
