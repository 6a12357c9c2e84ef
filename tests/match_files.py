"""Hand-made match files, one rule each. Names are A1..A11 for team Alpha, B1..B11 for Beta."""

from __future__ import annotations

import json

ALPHA = [f"A{k}" for k in range(1, 12)]
BETA = [f"B{k}" for k in range(1, 12)]
REGISTRY = {name: f"id-{name}" for name in ALPHA + BETA}


def ball(batter="A1", bowler="B11", runs=0, extras=None, wickets=None, non_striker="A2", total=None):
    extra_runs = sum(extras.values()) if extras else 0
    out = {
        "batter": batter, "bowler": bowler, "non_striker": non_striker,
        "runs": {"batter": runs, "extras": extra_runs, "total": runs + extra_runs if total is None else total},
    }
    if extras:
        out["extras"] = extras
    if wickets is not None:
        out["wickets"] = wickets
    return out


def out(player="A1", kind="bowled", fielders=None):
    wicket = {"player_out": player, "kind": kind}
    if fielders is not None:
        wicket["fielders"] = fielders
    return [wicket]


def over(number, *balls):
    return {"over": number, "deliveries": list(balls)}


def document(innings=None, registry=None, **info):
    base = {
        "match_type": "T20", "gender": "male", "season": "2020", "city": "Town", "venue": "Ground", "overs": 20,
        "balls_per_over": 6, "teams": ["Alpha", "Beta"], "dates": ["2020-01-02"], "player_of_match": ["A1"],
        "toss": {"winner": "Alpha", "decision": "bat"}, "outcome": {"winner": "Alpha", "by": {"runs": 12}},
        "players": {"Alpha": ALPHA, "Beta": BETA}, "registry": {"people": REGISTRY if registry is None else registry},
    }
    base.update(info)
    doc = {"meta": {"data_version": "1.0.0", "created": "2020-01-03", "revision": 1}, "info": base}
    if innings is not None:
        doc["innings"] = innings
    return doc


def innings(team, *overs, **more):
    return {"team": team, "overs": list(overs), **more}


def _without(*names):
    return {n: i for n, i in REGISTRY.items() if n not in names}


def files() -> dict[str, object]:
    four, six = ball(runs=4), ball(runs=6)
    plain = [
        innings("Alpha", over(0, four, ball(), six), over(1, ball(runs=1), ball(wickets=out()))),
        innings("Beta", over(0, ball("B1", "A11", 2, non_striker="B2")), over(1, ball("B1", "A10", 0, non_striker="B2"))),
    ]
    hit = lambda bowler="B11", n=0: ball(f"A{n + 1}", bowler, wickets=out(f"A{n + 1}"))
    return {
        "e01": document(plain),
        "e02": "{ this is not JSON",
        "e03": document(None),
        "e04": document([{"team": "Alpha", "forfeited": True}]),
        "e05": document([innings("Alpha", over(0))]),
        "e06": document([innings("Alpha", over(0, ball()), over(1, ball(runs=3)), powerplays=[
            {"type": "mandatory", "from": 0.1, "to": 0.6}, {"type": "batting", "from": 3, "to": 4},
            {"type": "mandatory", "from": 1, "to": 5}])]),
        "e07": document([innings("Alpha", over(0, ball(extras={"legbyes": 2, "noballs": 1})))]),
        "e08": document([innings("Alpha", over(0, ball(wickets=out("A1", "caught", [{"substitute": True}]) + out("A2", "run out"))))]),
        "e09": document([innings("Alpha", over(0, ball()))], event="Bare Cup"),
        "e10": document([innings("Alpha", over(0, ball()))], dates=["2020-13-01"],
                        event={"name": "Cup", "group": "A", "match_number": 7}),
        "e11": document([innings("Alpha", over(0, ball("A7")))], registry=_without("A7")),
        "e12": document([innings("Alpha", over(0, ball("Nobody Known")))]),
        "e13": document([innings("Alpha", over(0, ball("Mister A3")))], registry={**_without("A3"), "Mister A3": "id-A3"}),
        "e14": document([innings("Alpha", over(0, ball("A4")))], registry={**REGISTRY, "A4": "other-A4"}, dates=["2019-05-05"]),
        "e15": document([innings("Gamma", over(0, ball()))]),
        "e15b": document([innings("Alpha", over(0, ball()))], teams=["Alpha"]),
        "e16": document([innings("Alpha", over(0, {"batter": "A1", "bowler": "B11", "non_striker": "A2"}))]),
        "e17": document([innings("Alpha", over(0, ball()))], outcome={"winner": "Gamma"}),
        "e17b": document([innings("Alpha", over(0, ball()))], outcome={"result": "tie"}),
        "e18": document([innings("Alpha", over(248, *[ball(runs=8)] * 19))]),
        "e19": document([innings("Alpha", over(0, hit(n=0), ball("A2"), hit(n=1), ball("A3"), hit(n=2)),
                                 over(2, hit("B10", 3), hit("B10", 4)), over(4, hit("B10", 5)))]),
        "e20": document([innings("Alpha", over(0, ball(wickets=out("A2", "run out", [{"name": "B5"}]))))]),
        "e21": document([innings("Alpha", over(0, ball(wickets=out("A1", "caught", [{"name": "B9"}]))))]),
        "e22": document([innings("Alpha", over(0, *[ball("A1")] * 6, ball("A5")), over(1, ball("A3")))]),
    }


def write(folder) -> None:
    for name, content in files().items():
        # Some on one line, some over many, as files come.
        text = content if isinstance(content, str) else json.dumps(content, indent=1 if name > "e08" else None)
        (folder / f"{name}.json").write_text(text)
