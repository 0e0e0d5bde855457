"""Connection description and database scans. Credentials come from the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    driver: str
    user: str
    password: str = field(repr=False)

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
        }

    @classmethod
    def from_conf(cls, spark: SparkSession, prefix: str = "spark.lectern.jdbc"):
        """Read url, driver, user and password from the session settings."""
        names = ("url", "driver", "user", "password")
        return cls(**{n: spark.conf.get(f"{prefix}.{n}") for n in names})


def count_options(target: JdbcTarget, table: str) -> dict[str, str]:
    """The count runs in the database; one row comes back."""
    return {
        **target.options(),
        "query": f"SELECT COUNT(*) AS row_count FROM {table}",
    }


def jdbc_count(spark: SparkSession, target: JdbcTarget, table: str) -> DataFrame:
    return spark.read.format("jdbc").options(**count_options(target, table)).load()
