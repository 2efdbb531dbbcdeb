import json

from threadloom.plans import study
from threadloom.plans.sentiment_queries import make_stub


def dump(game, users):
    comments = []
    for t in range(6):
        for i, user in enumerate(users[t % 2:]):
            comments.append({
                "gameLabel": game, "videoId": "v", "threadId": f"{game}{t}", "commentId": f"{game}{t}-{i}",
                "isTopLevel": i == 0, "authorDisplayName": user.upper(), "authorChannelId": user,
                "replyToAuthorChannelId": None if i == 0 else users[t % 2],
                "text": ["a great song &amp; fun", "this is bad www.x.y", "so so"][(t + i) % 3],
                "publishedAt": f"2024-0{t + 1}-02T00:00:00Z", "likeCount": i,
            })
    return {"gameLabel": game, "searchQueries": ["q"], "collectedAtUtc": "2024-09-01T00:00:00Z",
            "videos": [{"gameLabel": game, "title": "clip", "videoId": "v", "comments": comments}]}


def test_all_stages(spark, tmp_path):
    dumps = []
    for game, users in (("one", ["a", "b", "c", "d"]), ("two", ["p", "q", "r"])):
        path = tmp_path / f"{game}.json"
        path.write_text(json.dumps(dump(game, users), indent=2))
        dumps.append(str(path))
    out = str(tmp_path / "out")
    study.analyse(spark, dumps, out, "vader")
    study.score(spark, out, "roberta", f"{out}/cache/roberta", make_stub)
    study.network(spark, out, "roberta")
    study.compare_methods(spark, out)
    study.sample_package(spark, dumps, out, str(tmp_path / "sample"), ["vader"])

    def read(name):
        return {r[0]: r.asDict() for r in spark.read.parquet(f"{out}/{name}").collect()}

    summary = read("tables/preprocessing_summary")
    assert summary["one"]["final_analysis_comments"] == 21 and summary["two"]["replies"] == 9
    network = read("vader/tables/network_summary")
    assert (network["one"]["nodes"], network["two"]["nodes"]) == (4, 3)
    assert network == read("roberta/tables/network_summary")  # scoring does not change the network
    scored = spark.read.parquet(f"{out}/vader/comments_with_network")
    assert scored.count() == 36 and scored.filter("sentiment_label is null or community_id is null").count() == 0
    agreement = read("sentiment_comparison/model_agreement_by_game")
    assert agreement["Overall"]["total_comments"] == 36
    assert spark.read.parquet(f"{out}/vader/tables/community_summary").filter("comments > 0 and users > 0").count() > 0
    assert spark.read.json(str(tmp_path / "sample" / "raw")).count() == 2
