"""Silver and gold builds, analyst queries, jobs and models."""
