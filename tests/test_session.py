from types import SimpleNamespace

import pytest

from carebasin import session


def fake(master, **settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default), set=settings.__setitem__)
    context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda key: None))
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_shared_folder_comes_from_the_session(spark):
    assert session.work_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    first, second = (session.fresh_folder(spark, "x") for _ in range(2))
    assert first != second and first.startswith(session.work_root(spark))


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(fake("yarn"))
    assert session.work_root(fake("yarn", **{"spark.checkpoint.dir": "s3://b/c/"})) == "s3://b/c"


def test_a_local_session_gets_one_folder():
    local = fake("local[2]")
    assert session.work_root(local) == session.work_root(local)


def test_settings_are_applied(spark):
    session.apply_settings(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
