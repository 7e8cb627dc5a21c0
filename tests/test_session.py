from types import SimpleNamespace

import pytest

from careflow.session import working_folder


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Session:
    def __init__(self, **settings):
        self.conf = Conf({key.replace("__", "."): value for key, value in settings.items()})


def test_working_folder_lies_in_the_shared_folder():
    session = Session(spark__checkpoint__dir="hdfs:///shared/", spark__master="yarn")
    first, second = working_folder(session, "x"), working_folder(session, "x")
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_otherwise_it_lies_in_the_warehouse():
    session = Session(spark__sql__warehouse__dir="hdfs:///warehouse")
    assert working_folder(session, "x").startswith("hdfs:///warehouse/_work/x-")


def test_no_machine_local_folder_on_a_cluster():
    session = Session(spark__sql__warehouse__dir="file:/home/spark-warehouse", spark__master="yarn")
    session.sparkContext = SimpleNamespace(master="yarn")
    with pytest.raises(ValueError, match="checkpoint"):
        working_folder(session, "x")
    session.sparkContext.master = "local[2]"
    assert working_folder(session, "x").startswith("file:/home/spark-warehouse/_work/x-")


def test_settings(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Shanghai"
