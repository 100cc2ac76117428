"""leadsieve: company qualification as Spark DataFrame jobs."""
