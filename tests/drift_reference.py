"""A plain reading of schema changes, to compare the operator with."""

import json
from collections import defaultdict

TYPE = {str: "string", bool: "boolean", int: "number", float: "number", list: "array", dict: "object"}


def changes(rows):
    """rows: (dataset, shard, file_seq, file_name, record_key, payload); gives (file_name, change, old, new)."""
    series = defaultdict(lambda: defaultdict(list))
    name = {}
    for ds, sh, seq, fn, key, payload in rows:
        series[ds, sh][seq].append((key, json.loads(payload)))
        name[ds, sh, seq] = fn
    out = set()
    for (ds, sh), files in series.items():
        last, prev = {}, None
        for seq in sorted(files):
            recs, fn = files[seq], name[ds, sh, seq]
            now = defaultdict(set)
            for _, r in recs:
                for k, v in r.items():
                    now[k] |= set() if v is None else {TYPE[type(v)]}
            if prev is None:
                last = {k: frozenset(v) for k, v in now.items()}
            else:
                gone, came = [k for k in last if k not in now], [k for k in now if k not in last]
                old_rec = {k: r for k, r in prev}
                renames = []
                for o in gone:
                    for n in came:
                        pairs = [(old_rec[k][o], r[n]) for k, r in recs if k in old_rec and old_rec[k].get(o) is not None and r.get(n) is not None]
                        if pairs and all(a == b and isinstance(a, bool) == isinstance(b, bool) for a, b in pairs):
                            renames.append((o, n))
                out |= {(fn, "renamed", o, n) for o, n in renames}
                out |= {(fn, "removed", o, "") for o in gone if o not in {x for x, _ in renames}}
                out |= {(fn, "added", "", n) for n in came if n not in {x for _, x in renames}}
                nxt = {}
                for n, types in now.items():
                    before = [n] if n in last else sorted(o for o, m in renames if m == n)
                    for o in before:
                        if types and last[o] and frozenset(types) != last[o]:
                            out.add((fn, "type_changed", o, n))
                    nxt[n] = frozenset(types) or next((last[o] for o in before if last[o]), frozenset())
                last = nxt
            prev = recs
    return out
