"""JDBC sink: one table per stream, with a key the database assigns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from eventweir.schemas import StreamSpec
from eventweir.sinks.retry import with_retries

CONF_PREFIX = "spark.eventweir.jdbc."


@dataclass(frozen=True)
class JdbcSink:
    """Where and how to write. Rows are inserted in batches of ``batch_size`` per connection;
    ``max_connections`` bounds the number of tasks that write at once.

    An append commits per task, so a retried batch can insert rows again: delivery is at
    least once. Only errors of the connection or of concurrency are retried; bad data fails at
    once.
    """

    url: str
    user: str | None = None
    password: str | None = None
    driver: str = "org.postgresql.Driver"
    batch_size: int = 1000
    retries: int = 5
    max_connections: int | None = None
    id_type: str = "SERIAL PRIMARY KEY"
    text_type: str = "TEXT"
    keyed = False

    @classmethod
    def from_conf(cls, spark: SparkSession, **overrides) -> JdbcSink:
        """Settings from ``spark.eventweir.jdbc.{url,user,password,driver}`` and, as numbers,
        ``{batch_size,retries,max_connections}``."""
        found = {k: spark.conf.get(CONF_PREFIX + k, None) for k in ("url", "user", "password", "driver")}
        numbers = {k: spark.conf.get(CONF_PREFIX + k, None) for k in ("batch_size", "retries", "max_connections")}
        found |= {k: int(v) for k, v in numbers.items() if v is not None}
        settings = {**{k: v for k, v in found.items() if v is not None}, **overrides}
        if "url" not in settings:
            raise ValueError(f"set {CONF_PREFIX}url")
        return cls(**settings)

    def __repr__(self) -> str:
        return f"JdbcSink(url={self.url!r}, user={self.user!r})"

    def writer_options(self, spec: StreamSpec) -> dict[str, str]:
        options = {
            "url": self.url,
            "dbtable": spec.table,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "batchsize": str(self.batch_size),
            "numPartitions": None if self.max_connections is None else str(self.max_connections),
        }
        return {name: value for name, value in options.items() if value is not None}

    def create_sql(self, spec: StreamSpec) -> str:
        columns = [f"idx {self.id_type}", *[c.ddl(self.text_type) for c in spec.columns]]
        return f"CREATE TABLE IF NOT EXISTS {spec.table} ({', '.join(columns)})"

    def ensure(self, spark: SparkSession, spec: StreamSpec) -> None:
        """Create the table, once, from the driver, before any row is written."""
        with_retries(lambda: self._execute(spark, self.create_sql(spec)), self.retries)

    def write(self, rows: DataFrame, spec: StreamSpec, batch_id: int, run: str = "none") -> None:
        writer = rows.write.format("jdbc").options(**self.writer_options(spec)).mode("append")
        with_retries(writer.save, self.retries)

    def _execute(self, spark: SparkSession, sql: str) -> None:
        jvm = spark.sparkContext._jvm
        # Makes a driver class from --jars / --packages known to DriverManager.
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.driver)
        properties = jvm.java.util.Properties()
        for name, value in (("user", self.user), ("password", self.password)):
            if value is not None:
                properties.setProperty(name, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            statement = connection.createStatement()
            try:
                statement.execute(sql)
            finally:
                statement.close()
        finally:
            connection.close()
