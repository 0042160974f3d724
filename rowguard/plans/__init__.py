"""Plans that combine checks into Spark jobs: annotate, results, metrics, suites, scans."""
