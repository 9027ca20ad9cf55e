"""Properties: canonicalise never drops rows; the LEFT star join keeps every
base row and equals a brute-force nested-loop join."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventweave.operators import canonical as C
from eventweave.operators.federate import SourceRef, federate

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

json_values = st.recursive(st.none() | st.booleans() | st.integers(-10**6, 10**6) | st.text(max_size=5),
                           lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=4), inner, max_size=3),
                           max_leaves=6)
records = st.one_of(
    st.dictionaries(st.sampled_from(["event_id", "id", "event_type", "customer_id", "amount", "payload",
                                     "occurred_at", "x"]), json_values, max_size=6).map(json.dumps),
    st.text(max_size=12),
)


@SETTINGS
@given(st.lists(records, min_size=1, max_size=25))
def test_canonicalise_never_drops_rows(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    tagged = C.canonicalise(df, with_status=True)
    good, bad = C.split(tagged)
    assert tagged.count() == len(texts)
    assert good.count() + bad.count() == len(texts)
    want_ok = 0            # objects; some hold values that do not fit their column
    for t in texts:
        try:
            want_ok += isinstance(json.loads(t), dict)
        except ValueError:
            pass
    assert tagged.where(~tagged[C.STATUS].isin(C.MALFORMED, C.NOT_OBJECT)).count() == want_ok
    assert C.canonicalise(df).count() == want_ok


keys = st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=12)


@SETTINGS
@given(keys, keys, keys)
def test_left_star_join_matches_brute_force(spark, a, b, c):
    frames = {n: spark.createDataFrame([(k, i) for i, k in enumerate(v)], "k int, v int")
              for n, v in (("a", a), ("b", b), ("c", c))}
    src = [SourceRef(None, "t", n, n, ("k", "v")) for n in ("a", "b", "c")]
    out = federate(spark, src, join_key="k", join_type="LEFT", limit=None, resolve=lambda s: frames[s.table])
    rows = sorted(tuple(-1 if x is None else x for x in r) for r in out.collect())
    want = []
    for i, ka in enumerate(a):
        mb = [(kb, j) for j, kb in enumerate(b) if ka is not None and kb == ka] or [(None, None)]
        mc = [(kc, j) for j, kc in enumerate(c) if ka is not None and kc == ka] or [(None, None)]
        want += [(ka, i, kb, jb, kc, jc) for kb, jb in mb for kc, jc in mc]
    assert rows == sorted(tuple(-1 if x is None else x for x in r) for r in want)
    assert out.select("a_v").distinct().count() == len(a)          # every base row kept
