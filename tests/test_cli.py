"""The command line drives the same jobs: ingest + speed over a queue folder,
a batch run, then countpageviews with the original date format."""

import pytest

from hourglass.plans import cli
from hourglass.sources import messages
from hourglass.sources import testdata as td
from tests.conftest import SF_SMALL


def test_kafka_arguments():
    a = cli.parser().parse_args(["ingest", "--kafka", "h:9092,i:9092", "--topic", "t", "--new", "n", "--checkpoint", "c",
                                 "--starting-offsets", "latest", "--kafka-option", "maxOffsetsPerTrigger=500"])
    place, options = cli.kafka_arguments(a)
    assert messages.kafka_options(*place, **options) == {
        "kafka.bootstrap.servers": "h:9092,i:9092", "subscribe": "t", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "500"}
    with pytest.raises(SystemExit):     # a queue is a folder or a topic, not both
        cli.parser().parse_args(["ingest", "--kafka", "h", "--source", "d", "--new", "n", "--checkpoint", "c"])
    with pytest.raises(SystemExit, match="--topic"):
        cli.kafka_arguments(cli.parser().parse_args(["speed", "--kafka", "h", "--realtime", "r", "--checkpoint", "c"]))


def test_cli_round_trip(spark, workdir, capsys):
    lines = td.message_lines(spark, SF_SMALL, kinds=("pageview",))
    lines.select("value").coalesce(2).write.text(f"{workdir}/queue")
    w = workdir
    cli.main(["ingest", "--source", f"{w}/queue", "--new", f"{w}/new",
              "--checkpoint", f"{w}/ck_i", "--once"], spark)
    cli.main(["speed", "--source", f"{w}/queue", "--realtime", f"{w}/rt",
              "--checkpoint", f"{w}/ck_s", "--once"], spark)
    cli.main(["batch", "--new", f"{w}/new", "--master", f"{w}/master", "--view", f"{w}/view",
              "--checkpoint", f"{w}/ck_b"], spark)
    top = cli.main(["inspect", "--view", f"{w}/view"], spark) \
        .where("granularity = 'm'").orderBy("total_pageviews", ascending=False).first()
    df = cli.main(["countpageviews", "--view", f"{w}/view", "--realtime", f"{w}/rt",
                   "--pageid", top.url, "--datestart", "01.01.2024|00",
                   "--dateend", "31.01.2024|23"], spark)
    r = df.first()
    # everything is in the batch view, so the realtime side adds nothing
    assert r.batch_pageviews > 0 and r.realtime_pageviews == 0
    assert "pageviews" in capsys.readouterr().out
