"""Small match and shot files for the scenario tests."""

import json

ARG, AUS, FRA, ESP, MAR, ENG = 779, 792, 771, 772, 788, 768
FINAL = 3869685
VERSION = "2024-12-16T10:15:11.055845"
LATER = "2026-09-23T12:00:00"
DI_MARIA = "ef86f4d9-7acd-4ed0-a5ec-9129079e8fbe"
MBAPPE = "6cc0d5e2-6999-4006-8a7a-34de4cbe3ffd"
PARTNER = "6d527ebc-a948-4cd8-ac82-daced35bb715"
NAMES = {ARG: "Argentina", AUS: "Australia", FRA: "France", ESP: "Spain", MAR: "Morocco", ENG: "England"}
COACH = {ARG: (5677, "Lionel Scaloni"), AUS: (100, "Graham Arnold"), FRA: (545, "Didier Deschamps"),
         MAR: (101, "Walid Regragui"), ENG: (102, "Gareth Southgate")}


def match(mid, day, home, away, score, stage, managers, version=VERSION, **more):
    def side(where, team):
        return {f"{where}_team_id": team, f"{where}_team_name": NAMES[team],
                "managers": [{"id": i, "name": n, "country": None} for i, n in managers[team]]}
    return {"match_id": mid, "match_date": day, "kick_off": "17:00:00.000", "last_updated": version,
            "competition": {"competition_id": 43, "competition_name": "World Cup"},
            "season": {"season_id": 106, "season_name": "2022"}, "competition_stage": {"id": 26, "name": stage},
            "home_team": side("home", home), "away_team": side("away", away), "home_score": score[0],
            "away_score": score[1], "stadium": {"name": "S"}, "referee": {"name": "R"}, **more}


def shot(eid, mid, team, player, xg, outcome="Saved", kind="Open Play", period=1, version=VERSION, tag=None, first=None):
    body = {"type": {"name": kind}, "outcome": {"name": outcome}, "body_part": {"name": "Head"},
            "technique": {"name": "Normal"}, "statsbomb_xg": xg}
    if first is not None:
        body["first_time"] = first
    source = {"match_id": mid, "version": version, "file": f"events/{mid}.json"}
    if tag:
        source["test_case"] = tag
    record = {"id": eid, "index": 1, "period": period, "minute": 35, "second": 22, "timestamp": "00:34:24.975",
              "type": {"name": "Shot"}, "team": {"id": team, "name": NAMES[team]},
              "player": {"id": player, "name": f"Player {player}"}, "position": {"name": "Wing"},
              "play_pattern": {"name": "Regular"}, "shot": body, "location": [111.8, 32.1]}
    return {"_source": source, "record": record}


def managers(**override):
    base = {t: [m] for t, m in COACH.items()}
    base |= {int(k[1:]): v for k, v in override.items()}
    return base


def matches():
    old, new = managers(t772=[(9000, "Luis Enrique")]), managers(t772=[(9001, "De la Fuente")])
    return [match(3869151, "2022-12-03", ARG, AUS, (2, 1), "Round of 16", old),
            match(3869220, "2022-12-06", MAR, ESP, (0, 0), "Round of 16", old),
            match(FINAL, "2022-12-18", ARG, FRA, (3, 3), "Final", old),
            match(3943043, "2024-07-14", ESP, ENG, (2, 1), "Final", new)]


def shots():
    def eid(n):
        return f"00000000-0000-4000-8000-{n:012d}"
    return [
        shot(eid(1), 3869151, ARG, 5503, 0.1, "Goal"), shot(eid(2), 3869151, ARG, 5503, 0.05, "Off T"),
        shot(eid(3), 3869151, AUS, 1, 0.2, "Goal"), shot(eid(4), 3869220, ESP, 2, 0.30340917),
        shot(eid(5), 3869220, ESP, 2, 0.7835, "Saved", "Penalty", 5), shot(eid(6), 3869220, MAR, 3, 0.01, "Blocked"),
        shot(DI_MARIA, FINAL, ARG, 2995, 0.30340916, "Goal", first=True), shot(eid(7), FINAL, ARG, 5503, 0.7835, "Goal", "Penalty"),
        shot(MBAPPE, FINAL, FRA, 3009, 0.7835, "Goal", "Penalty"), shot(eid(8), FINAL, FRA, 3009, 0.12, "Saved to Post"),
        shot(eid(9), FINAL, FRA, 3009, 0.7835, "Goal", "Penalty", 5), shot(eid(10), 3943043, ESP, 4, 0.4, "Goal"),
        shot(eid(11), 3943043, ENG, 5, 0.33, "Goal"), shot(eid(12), 3943043, ENG, 5, 0.02, "Wayward")]


def by_id(eid):
    return next(s for s in shots() if s["record"]["id"] == eid)


def write(root, name, lines, blank=False):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    text = [json.dumps(x, ensure_ascii=False, sort_keys=True) for x in lines]
    path.write_text(("\n\n" if blank else "\n").join(text) + "\n", encoding="utf-8")


def write_inputs(root):
    """Input folder with the baseline and one extra file per scenario."""
    write(root, "baseline/matches.jsonl", [{"_source": {"file": "m"}, "record": m} for m in matches()], blank=True)
    write(root, "baseline/shots.jsonl", shots())
    write(root, "scenarios/resend.jsonl", [by_id(DI_MARIA)])
    write(root, "scenarios/conflict.jsonl", [shot(DI_MARIA, FINAL, ARG, 2995, 0.30340916, "Saved", first=True)])
    write(root, "scenarios/correction.jsonl", [shot(DI_MARIA, FINAL, ARG, 2995, 0.45, "Goal", version=LATER, first=True)])
    write(root, "scenarios/bad_xg.jsonl", [shot(MBAPPE, FINAL, FRA, 3009, 7.835, "Goal", "Penalty", version=LATER, tag="corrupted")])
    two = managers(t779=[COACH[ARG], (990000001, "Co-manager")], t772=[(9000, "Luis Enrique")])
    write(root, "scenarios/two_managers.jsonl", [{"record": match(FINAL, "2022-12-18", ARG, FRA, (3, 3), "Final", two, LATER)}])
    partner = managers(t779=[(5677, "Partner Manager")])
    write(root, "scenarios/partner_matches.jsonl", [{"_source": {}, "record": match(FINAL, "2022-12-18", ARG, FRA, (1, 0), "Final", partner, LATER)}])
    write(root, "scenarios/partner_shots.jsonl", [shot(PARTNER, FINAL, ARG, 5503, 0.5, "Goal", version=LATER)])
    base = [("baseline/matches.jsonl", "matches", "statsbomb"), ("baseline/shots.jsonl", "shots", "statsbomb")]
    extra = {"baseline": [], "duplicate": [("scenarios/resend.jsonl", "shots", "statsbomb")],
             "conflict": [("scenarios/conflict.jsonl", "shots", "statsbomb")],
             "correction": [("scenarios/correction.jsonl", "shots", "statsbomb")],
             "corrupted": [("scenarios/bad_xg.jsonl", "shots", "statsbomb")],
             "overlap": [("scenarios/two_managers.jsonl", "matches", "statsbomb")],
             "partner": [("scenarios/partner_matches.jsonl", "matches", "partner_demo"),
                         ("scenarios/partner_shots.jsonl", "shots", "partner_demo")]}
    (root / "manifests").mkdir()
    for name, more in extra.items():
        listed = [{"path": p, "entity": e, "source_system": s} for p, e, s in base + more]
        (root / "manifests" / f"{name}.json").write_text(json.dumps({"scenario": name, "description": "", "files": listed}))
