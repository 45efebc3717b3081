"""Synthetic seed tables with the profile of the reference's two seed
scripts (counts, value ranges and which rows sit above the watermark), built
from a rule and a fixed random seed. No seed row is copied."""

from __future__ import annotations

import datetime as dt
import random

INIT_MARK = dt.datetime(2025, 10, 7, 19, 49, 55)
FACT_MARK = dt.datetime(2025, 10, 7, 19, 49, 56)

USER_SCHEMA = ("user_id int, user_name string, country string, subscription_type string, "
               "start_date date, end_date date, updated_at timestamp_ntz")
ARTIST_SCHEMA = "artist_id int, artist_name string, genre string, country string, updated_at timestamp_ntz"
TRACK_SCHEMA = ("track_id int, track_name string, artist_id int, album_name string, duration_sec int, "
                "release_date date, updated_at timestamp_ntz")
DATE_SCHEMA = "date_key int, date date, day int, month int, year int, weekday string"
FACT_SCHEMA = ("stream_id bigint, user_id int, track_id int, date_key int, listen_duration int, "
               "device_type string, stream_timestamp timestamp_ntz")

COUNTRIES = ["India", "USA", "UK", "Canada", "Germany", "Brazil", "Japan", "Australia"]
SUBS = ["Free", "Family", "Premium"] * 167
GENRES = ["Pop", "Hip-Hop", "Jazz", "Electronic", "Rock", "Classical"] * 84
DEVICES = ["Mobile", "Desktop", "Smart Speaker"] * 334


def _stamp(rng, first: dt.date, last: dt.date, second: int) -> dt.datetime:
    day = first + dt.timedelta(days=rng.randint(0, (last - first).days))
    return dt.datetime(day.year, day.month, day.day, 19, 49, second)


def build(seed: int = 7):
    rng = random.Random(seed)
    d0, d1 = dt.date(2025, 9, 7), dt.date(2025, 10, 6)   # strictly before the mark day
    subs, genres, devices = SUBS[:], GENRES[:], DEVICES[:]
    rng.shuffle(subs), rng.shuffle(genres), rng.shuffle(devices)

    users = [(i, f"user {i}" + ("'s" if i % 37 == 0 else ""), rng.choice(COUNTRIES), subs[i - 1],
              dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 500)), None,
              INIT_MARK if i == 500 else _stamp(rng, d0, d1, 55)) for i in range(1, 501)]
    artists = [(i, f"artist {i}", genres[i - 1], rng.choice(COUNTRIES),
                INIT_MARK if i == 500 else _stamp(rng, d0, d1, 55)) for i in range(1, 501)]
    tracks = []
    for i in range(1, 501):
        dur = 150 if i <= 5 else 300 if i <= 9 else rng.randint(90, 360)
        name = f"song-{i}" if rng.random() < 0.6 else f"song {i}"
        tracks.append((i, name, rng.randint(1, 500), f"album {i % 40}", dur,
                       dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 1800)),
                       INIT_MARK if i == 500 else _stamp(rng, d0, d1, 55)))
    dates = []
    for k in range(365):
        d = dt.date(2024, 10, 7) + dt.timedelta(days=k)
        dates.append((int(d.strftime("%Y%m%d")), d, d.day, d.month, d.year, d.strftime("%A")))
    dur_of = {t[0]: t[4] for t in tracks}
    facts = []
    track_pool = [t for t in range(1, 501) if t not in (5, 46)]
    for i in range(1, 1001):
        tid = 5 if i <= 3 else 46 if i <= 6 else rng.choice(track_pool)
        sec = 56 if i > 875 else 55
        ts = FACT_MARK if i == 1000 else _stamp(rng, dt.date(2025, 9, 27), dt.date(2025, 10, 7), sec)
        facts.append((i, rng.randint(1, 500), tid, rng.choice(dates)[0],
                      rng.randint(10, min(345, dur_of[tid])), devices[i - 1], ts))

    # --- incremental load: existing keys only; few rows above the marks ---
    above = dt.datetime(2025, 10, 7, 19, 49, 56)
    u_ids = rng.sample(range(1, 500), 69)
    inc_users = []
    for n, uid in enumerate(u_ids):
        base = users[uid - 1]
        if n < 20:                      # above the mark
            sub = base[3] if n < 2 else next(s for s in ("Free", "Family", "Premium") if s != base[3])
            inc_users.append(base[:3] + (sub,) + base[4:6] + (above,))
        else:                           # below the mark: lost by the strict extract
            inc_users.append(base[:3] + (rng.choice(["Free", "Family", "Premium"]),) + base[4:6]
                             + (_stamp(rng, d0, d1, 56),))
    dup = inc_users[-1]
    inc_users.append(dup[:6] + (dup[6] - dt.timedelta(days=1),))   # 70 rows, 69 keys
    a_ids = rng.sample(range(5, 500), 49)
    inc_artists = [artists[3][:4] + (above,)]
    inc_artists += [artists[a - 1][:2] + (rng.choice(GENRES),) + artists[a - 1][3:4] + (_stamp(rng, d0, d1, 56),)
                    for a in a_ids]
    t_ids = [5, 46] + rng.sample([t for t in range(1, 500) if t not in (5, 46)], 48)
    inc_tracks = []
    for n, tid in enumerate(t_ids):
        base = tracks[tid - 1]
        ts = above if n < 2 else _stamp(rng, d0, d1, 56)
        inc_tracks.append(base[:1] + (base[1] + " remix",) + base[2:6] + (ts,))
    f_ids = rng.sample(range(1, 1000), 300)
    inc_facts = []
    for n, fid in enumerate(f_ids):
        base = facts[fid - 1]
        ts = FACT_MARK if n < 21 else _stamp(rng, dt.date(2025, 9, 27), dt.date(2025, 10, 6), 56)
        inc_facts.append(base[:4] + (max(10, base[4] - 1),) + base[5:6] + (ts,))
    return {
        "initial": {"dim_user": users, "dim_artist": artists, "dim_track": tracks, "dim_date": dates,
                    "fact_stream": facts},
        "incremental": {"dim_user": inc_users, "dim_artist": inc_artists, "dim_track": inc_tracks,
                        "dim_date": [], "fact_stream": inc_facts},
        "schemas": {"dim_user": USER_SCHEMA, "dim_artist": ARTIST_SCHEMA, "dim_track": TRACK_SCHEMA,
                    "dim_date": DATE_SCHEMA, "fact_stream": FACT_SCHEMA},
    }
