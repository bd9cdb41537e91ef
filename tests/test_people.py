import json
from collections import Counter

from pyspark.sql import functions as F

from marquee.operators import people

MOVIES = [
    (1, "One", 1990, 8.0, [("Ann", 1), ("Bob", 2), ("Cy", 0)], [("Dee", "Director"), ("Ann", "Writer"), ("Eve", "Editor")]),
    (2, "Two", 1991, 6.0, [("Ann", 1), ("Bob", 2), ("Ann", 1)], [("Dee", "Director")]),
    (3, "Three", 1990, None, [("Bob", 2)], [("Fay", "Producer")]),
    (4, "Four", 1999, 9.0, None, None),
]


IDS = {"Ann": 1, "Bob": 2, "Cy": 3, "Dee": 4, "Eve": 5, "Fay": 6}


def serialized(entries, field):
    if entries is None:
        return None
    return json.dumps([{"id": IDS.get(n), "name": n, field: v} for n, v in entries])


def movies(spark):
    rows = [
        (i, t, y, r, serialized(cast, "gender"), serialized(crew, "job"), "Gus, Ann", "Dee", "N/A")
        for i, t, y, r, cast, crew in MOVIES
    ]
    return spark.createDataFrame(
        rows, "tmdb_id int, title string, year int, rating double, cast_data string, crew_data string, "
        "omdb_actors string, omdb_director string, omdb_writer string",
    )


def test_credits(spark):
    rows = people.credits(movies(spark)).collect()
    assert all(r.key == (r.person if r.tmdb_id == 4 else f"#{IDS[r.person]}") for r in rows)
    assert Counter((r.tmdb_id, r.person, r.role) for r in rows) == Counter([
        (1, "Ann", "actress"), (1, "Bob", "actor"), (1, "Cy", "actor"),
        (1, "Dee", "director"), (1, "Ann", "writer"), (1, "Eve", "crew"),
        (2, "Ann", "actress"), (2, "Bob", "actor"), (2, "Ann", "actress"), (2, "Dee", "director"),
        (3, "Bob", "actor"), (3, "Fay", "producer"),
        (4, "Gus", "actor"), (4, "Ann", "actor"), (4, "Dee", "director"),
    ])
    split = people.cast_credits(movies(spark)).unionByName(people.crew_credits(movies(spark)))
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, rows))


def test_malformed_list_gives_no_rows(spark):
    df = spark.createDataFrame([(1, "not json", "[]")], "tmdb_id int, cast_data string, crew_data string")
    assert people.credits(df).count() == 0


def test_rankings(spark):
    rows = people.credits(movies(spark), keep=("rating",))
    top = people.top_people(rows, 2, "rating", F.col("role") == "director").collect()
    assert [tuple(r) for r in top] == [("#4", "Dee", 2, 7.0), ("Dee", "Dee", 1, 9.0)]
    rated = people.person_ratings(rows.filter("role = 'actor'"), "rating", at_least=2).collect()
    assert [tuple(r) for r in rated] == [("#2", "Bob", 7.0, 2)]


def test_two_people_of_one_name(spark):
    cast = json.dumps([{"id": 1, "name": "A", "gender": 2}, {"id": 2, "name": "A", "gender": 2}, {"name": "A", "gender": 2}])
    rows = people.credits(spark.createDataFrame([(1, cast), (2, cast)], "tmdb_id int, cast_data string"))
    assert [tuple(r) for r in people.cast_summary(rows).collect()] == [("actor", 3, 6)]
    strength = people.collaboration_strength(rows, "tmdb_id").collect()
    assert {(r.key, r.person, r.movies, r.shared_appearances, r.most_partners) for r in strength} == {
        (k, "A", 2, 4, 2) for k in ("#1", "#2", "A")}


def test_summary(spark):
    row = people.cast_totals(people.credits(movies(spark))).first().asDict()
    assert row == {
        "total_actors": 4, "total_actresses": 1, "total_directors": 2, "total_writers": 1,
        "total_producers": 1, "total_cast_appearances": 9, "total_crew_appearances": 6,
        "total_collaboration_networks": 3,
    }
    empty = people.cast_totals(people.credits(movies(spark)).filter("tmdb_id > 9")).first()
    assert set(empty) == {0}


def test_filmographies_in_order(spark):
    rows = people.filmographies(
        people.cast_credits(movies(spark), keep=("year", "title")), "tmdb_id", "year", "title"
    ).collect()
    lists = {}
    for r in rows:
        lists.setdefault(r.key, []).append((r.person, r.title))
    assert lists == {
        "#1": [("Ann", "One"), ("Ann", "Two")], "Ann": [("Ann", "Four")],
        "#2": [("Bob", "One"), ("Bob", "Three"), ("Bob", "Two")], "#3": [("Cy", "One")], "Gus": [("Gus", "Four")],
    }


def cast_pairs():
    casts = {1: {"#1", "#2", "#3"}, 2: {"#1", "#2"}, 3: {"#2"}, 4: {"Gus", "Ann"}}
    return casts, Counter(
        (a, b) for people_ in casts.values() for a in people_ for b in people_ if a != b
    )


def test_networks_against_all_pairs(spark):
    casts, pairs = cast_pairs()
    cast = people.cast_credits(movies(spark))
    everyone = people.leader_network(cast, "tmdb_id", k=100).collect()
    assert {(r.leader_key, r.partner_key): r.shared_movies for r in everyone} == dict(pairs)
    assert {r.leader for r in everyone} == {"Ann", "Bob", "Cy", "Gus"}
    leaders = people.leader_network(cast, "tmdb_id", k=2).collect()
    assert {(r.leader_key, r.partner_key): r.shared_movies for r in leaders} == {
        pair: n for pair, n in pairs.items() if pair[0] in ("#1", "#2")
    }
    strength = {r.key: (r.movies, r.shared_appearances) for r in
                people.collaboration_strength(cast, "tmdb_id").collect()}
    for name, (films, shared) in strength.items():
        assert films == sum(name in c for c in casts.values())
        assert shared == sum(n for (a, _), n in pairs.items() if a == name)


def test_director_network(spark):
    directors = people.director_credits(movies(spark))
    edges = people.director_network(people.cast_credits(movies(spark)), directors, "tmdb_id").collect()
    assert {(r.director_key, r.key): r.shared_movies for r in edges} == {
        ("#4", "#1"): 2, ("#4", "#2"): 2, ("#4", "#3"): 1, ("Dee", "#2"): 1, ("Dee", "Gus"): 1, ("Dee", "Ann"): 1,
    }


def test_all_directors_of_a_movie(spark):
    cast = json.dumps([{"id": 1, "name": "A"}])
    crew = json.dumps([{"id": 8, "name": "D1", "job": "Director"}, {"id": 9, "name": "D2", "job": "Director"}])
    df = spark.createDataFrame(
        [(1, cast, crew, None), (2, cast, "[]", "D3, D4"), (3, cast, None, "D3")],
        "tmdb_id int, cast_data string, crew_data string, director string")
    edges = people.director_network(people.cast_credits(df), people.director_credits(df), "tmdb_id").collect()
    assert {(r.director, r.person): r.shared_movies for r in edges} == {
        ("D1", "A"): 1, ("D2", "A"): 1, ("D3", "A"): 2, ("D4", "A"): 1}


def test_director_network_moves_pairs_once(spark):
    """A pair with several names is one row, of the least names; one shuffle of the pairs gathers it."""
    schema = "tmdb_id int, key string, person string"
    cast = spark.createDataFrame([(1, "#1", "Bo"), (2, "#1", "Al"), (2, "#2", "Cy"), (3, "#1", "Di"), (None, "#1", "X")], schema)
    directors = spark.createDataFrame([(1, "#9", "Q"), (1, "#9", "R"), (2, "#9", "P"), (3, "#8", "Z")], schema)
    edges = people.director_network(cast, directors, "tmdb_id")
    assert sorted(edges.collect()) == [("#8", "#1", "Z", "Di", 1), ("#9", "#1", "P", "Al", 2), ("#9", "#2", "P", "Cy", 1)]
    plan = people.director_network(cast, directors, "tmdb_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3
