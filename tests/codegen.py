"""Sizes of the code that Spark generates for a plan."""


def largest_method(df) -> int:
    """Bytes of the largest generated method; HotSpot compiles none above 8,000."""
    spark = df.sparkSession
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, df._jdf.queryExecution().logical()).queryExecution().executedPlan()
        module = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        found = module.codegenStringSeq(plan)
        return max((found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())), default=0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
