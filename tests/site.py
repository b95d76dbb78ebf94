"""Writes a small site of contest pages, the input of the whole job."""

from __future__ import annotations

import datetime as dt
import os
import random

STANCES = ["Orthodox", "Southpaw", "Switch", "Open Stance"]
METHODS = ["KO/TKO", "Submission", "Decision - Split"]
HOST = "http://site.example"


def put(folder, name, html):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{name}.html"), "w") as handle:
        handle.write(html)


def hex_id(kind, number):
    return f"{kind}{number:015x}"


def event_list(events):
    rows = "".join(
        f'<tr class="b-statistics__table-row"><td><i><a href="{HOST}/event-details/{e["id"]}" '
        f'class="b-link b-link_style_black">\n  {e["name"]}\n</a>'
        f'<span class="b-statistics__date">\n {e["date"]}\n</span></i></td>'
        f"<td>\n  {e['place']} \n</td></tr>"
        for e in events
    )
    blank = '<tr class="b-statistics__table-row"><td></td></tr>'
    return f"<html><table><thead><tr><th>Name</th></tr></thead><tbody>{blank}{rows}</tbody></table>"


def event_page(fights):
    rows = "".join(
        f'<tr class="row" data-link="{HOST}/fight-details/{f["id"]}"><td><p>win</p></td>'
        f"<td><p>\n  Women's {f['weight']}weight\n</p><p>bonus</p></td></tr>"
        for f in fights
    )
    head = "<thead><tr><th>W/L</th><th> Weight class </th></tr></thead>"
    return f"<html><table>{head}<tbody>{rows}</tbody></table>"


def stats_table(names, rows):
    def cells(values):
        return "".join(f"<td><p>{a}</p>\n<p>{b}</p></td>" for a, b in values)

    people = "".join(f'<p><a href="x"> {n} </a></p>' for n in names)
    body = "".join(f"<tr><td>{people}</td>{cells(r)}</tr>" for r in rows)
    head = "<thead><tr><th>Fighter</th><th>KD</th><th>Sig. str.</th><th>Sig. str. %</th><th>Ctrl</th></tr></thead>"
    return f"<table>{head}<tbody>{body}</tbody></table>"


def fight_page(f, completed):
    a, b = f["sides"]
    people = ""
    for side, status in ((a, f["status"][0]), (b, f["status"][1])):
        mark = f'<i class="b-fight-details__person-status w">\n {status}\n</i>' if completed else ""
        people += (
            f'<div class="b-fight-details__person">{mark}<h3><a class="b-link '
            f'b-fight-details__person-link" href="{HOST}/fighter-details/{side["id"]}">'
            f'{side["name"]} </a></h3></div>'
        )
    html = (
        f'<html><h2 class="b-content__title"><a href="{HOST}/event-details/{f["event"]["id"]}">'
        f' {f["event"]["name"]} </a></h2>{people}'
        f'<i class="b-fight-details__fight-title">\n Women\'s {f["weight"]}weight Bout </i>'
    )
    if not completed:
        return html

    def detail(label, value, first=""):
        return (
            f'<i class="b-fight-details__text-item{first}">\n<i class="b-fight-details__label">\n'
            f"{label}:\n</i>\n<i> {value}\n</i></i>\n"
        )

    html += (
        '<div class="b-fight-details__content"><p class="b-fight-details__text">'
        + detail("Method", f["method"], "_first")
        + detail("Round", f["round"])
        + detail("Time", "4:05")
        + detail("Time format", "3 Rnd (5-5-5)")
        + detail("Referee", "A. Judge")
        + '</p><p class="b-fight-details__text">'
        + detail("Details", "Rear Choke")
        + "</p></div>"
    )
    if f["stats"]:
        order = (1, 0) if f["swap"] else (0, 1)
        names = [f["sides"][i]["name"] for i in order]

        def row(kd):
            return [
                tuple(kd[i] for i in order),
                tuple(f"{kd[i] + 3} of {kd[i] + 9}" for i in order),
                tuple(f"{kd[i] * 10}%" for i in order),
                tuple("---" if kd[i] == 0 else f"{kd[i]}:30" for i in order),
            ]

        whole = stats_table(names, [row(f["kd"])])
        rounds = stats_table(names, [row(f["kd"])] * f["round"])
        html += f"<section>{whole}</section>{rounds}{whole}{rounds}"
    return html


def profile_page(p):
    facts = "".join(
        f'<li>\n<i class="b-list__box-item-title">{k}:\n</i>\n   {v}\n</li>' for k, v in p["facts"]
    )
    return (
        f'<html><span class="b-content__title-highlight">\n{p["name"]}\n</span>'
        f'<span class="b-content__title-record"> Record: {p["record"]}\n</span>'
        f'<p class="b-content__Nickname">\n {p["nickname"]}\n</p>'
        f'<ul class="b-list__box-list">{facts}<li></li></ul>'
        f'<ul class="b-list__box-list b-list__box-list_margin"><li><i>SLpM:</i> 3.5 </li>'
        f"<li><i>Str. Acc.:</i> 45% </li></ul>"
    )


def build(root, fighters=14, events=40, upcoming=3, seed=11):
    """Returns what was written: {people, completed, upcoming}."""
    rng = random.Random(seed)
    people = []
    for i in range(fighters):
        reach = "--" if i == fighters - 1 else f'{70 + i}"'
        people.append(
            {
                "id": hex_id("a", i),
                "name": f"Fighter {i}",
                "record": f"{10 + i}-2-1",
                "nickname": "" if i % 3 else f"The {i}",
                "skill": rng.random(),
                "stance": STANCES[i % 3],
                "reach": reach,
                "facts": [
                    ("Height", f"5' {i % 12}\""),
                    ("Weight", "155 lbs."),
                    ("Reach", reach),
                    ("STANCE", STANCES[i % 3]),
                    ("DOB", f"Jan {i + 1:02}, 1990" if i % 2 else f"January {i + 1}, 1991"),
                ],
            }
        )
    day = dt.date(2019, 1, 5)
    fights = {"completed": [], "upcoming": []}
    listed = {"completed": [], "upcoming": []}
    number = 0
    for e in range(events + upcoming):
        kind = "completed" if e < events else "upcoming"
        day += dt.timedelta(days=14)
        event = {
            "id": hex_id("e", e),
            "name": f"Night {e} &amp; More",
            "day": day,
            "date": day.strftime("%B %d, %Y") if e % 2 else day.strftime("%b %d, %Y"),
            "place": "Abu Dhabi, UAE" if e % 5 == 0 else "Las Vegas, Nevada, USA",
        }
        listed[kind].append(event)
        pool = rng.sample(people, 8)
        for n in range(4):
            a, b = pool[2 * n : 2 * n + 2]
            first = rng.random() < 0.5 + 0.6 * (a["skill"] - b["skill"])
            draw = number % 23 == 22
            fights[kind].append(
                {
                    "id": hex_id("f", number),
                    "event": event,
                    "sides": (a, b),
                    "status": ("D", "D") if draw else ("W", "L") if first else ("L", "W"),
                    "weight": rng.choice(["Straw", "Fly"]),
                    "method": METHODS[number % 3],
                    "round": 1 + number % 3,
                    "kd": (rng.randrange(4), rng.randrange(4)),
                    "swap": number % 4 == 0,
                    "stats": number % 17 != 16,
                }
            )
            number += 1
    for kind in ("completed", "upcoming"):
        html = f"{root}/01_raw/html/{kind}"
        put(f"{html}/eventlist", "page1", event_list(listed[kind]))
        for event in listed[kind]:
            put(f"{html}/events", event["id"], event_page([f for f in fights[kind] if f["event"] is event]))
        for f in fights[kind]:
            put(f"{html}/fights", f["id"], fight_page(f, kind == "completed"))
    links = "".join(
        f'<tr><td><a href="{HOST}/fighter-details/{p["id"]}">F</a></td>'
        f'<td><a href="{HOST}/fighter-details/{p["id"]}">L</a></td></tr>'
        for p in people
    )
    put(f"{root}/01_raw/html/fighterlist", "page1", f"<table><tbody><tr><td></td></tr>{links}</tbody></table>")
    for p in people:
        put(f"{root}/01_raw/html/fighters", p["id"], profile_page(p))
    return {"people": people, **fights}
