"""Fixture rows of the listening log and the event stream."""

from __future__ import annotations

import datetime as dt
import json
import zipfile
from pathlib import Path

# fixed values: ids, titles and times with a known result
USER_SHA = "c64ba6063cb5efef6934052fd04f977a3fd3a53c135c8e94f4e53d555ff6db9e"
ARTIST = "f1d39567-27e7-40af-852a-abaed88ec838"

# listened_at, recording_msid, track_name
LISTENS = [
    (1555286560, "1e1b2aa0-b2db-42ed-a8ba-89c303499408", "Love In the Time of Ecstacy"),
    (1555286378, "283062c8-75e2-406a-8c5e-f38136aa5a68", "Cornflake"),
    (1555286137, "8fe0c93d-f44a-4159-b069-5cc3c2e9c16b", "Providence"),
]

USERS_EXPECTED = [(USER_SHA, "NichoBI")]
ARTISTS_EXPECTED = [(ARTIST, "Withered Hand")]
TIME_EXPECTED = [
    (1555286137, dt.datetime(2019, 4, 14, 23, 55, 37), dt.date(2019, 4, 14), 2019, 4, 14, "Sunday", 23),
    (1555286378, dt.datetime(2019, 4, 14, 23, 59, 38), dt.date(2019, 4, 14), 2019, 4, 14, "Sunday", 23),
    (1555286560, dt.datetime(2019, 4, 15, 0, 2, 40), dt.date(2019, 4, 15), 2019, 4, 15, "Monday", 0),
]
LISTENS_EXPECTED = sorted((i, USER_SHA, t, ARTIST, song, "Good News") for t, i, song in LISTENS)


def listen(time, id, song, user="NichoBI", artist=ARTIST, artist_name="Withered Hand", album="Good News"):
    """One record of the log, with the fields the job ignores."""
    info = dict.fromkeys(
        "release_mbid recording_mbid release_group_mbid isrc spotify_id tracknumber track_mbid".split()
    )
    info |= {"artist_mbids": [], "tags": [], "work_mbids": []}
    info |= {"artist_msid": artist, "recording_msid": id, "release_msid": "34dbfc73-31e4-45c3-9d6e-04d8b6c5fd4a"}
    track = {"additional_info": info, "artist_name": artist_name, "track_name": song, "release_name": album}
    return {"track_metadata": track, "listened_at": time, "recording_msid": id, "user_name": user}


def lines(records) -> str:
    """JSON lines without a final line end."""
    return "\n".join(json.dumps(r, ensure_ascii=False) for r in records)


def records() -> list[dict]:
    return [listen(*row) for row in LISTENS]


def write_text(path: Path, content: str) -> str:
    path.write_text(content, encoding="utf-8")
    return str(path)


def write_zip(path: Path, members: dict[str, str]) -> str:
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return str(path)


EVENT = {
    "event_uuid": "78d1b928-37e0-41a0-bf41-ea9d86b27e5a",
    "event_name": "payment:order:completed",
    "created_at": 1712511721.022075,
}


def rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)
