"""A slow, plain slice graph to compare with."""

from collections import defaultdict


def brute_force(games):
    graph = {}
    index = defaultdict(dict)
    for game in sorted(games, key=lambda g: (g.game_date, g.match_id)):
        document = (game.season, game.competition)
        entities = [
            ("team", game.home_team, None, game.image_path_home), ("team", game.away_team, None, game.image_path_away),
            ("place", game.stadium, game.city, None), ("stage", game.stage, None, None), ("date", game.game_date, None, None),
        ]
        found = []
        for kind, key, city, image in entities:
            number = index[document].setdefault((kind, key), len(index[document]))
            entry = graph.setdefault(
                (*document, number),
                {"type": kind, "key": key, "city": city, "image": image, "matches": [], "dependencies": set()},
            )
            entry["matches"].append(game.match_id)
            found.append((number, kind))
        for number, kind in found:
            graph[(*document, number)]["dependencies"] |= {n for n, k in found if k != kind}
    for entry in graph.values():
        entry["dependencies"] = sorted(entry["dependencies"])
    return graph
