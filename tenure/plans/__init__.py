"""The jobs: bronze, silver, dimensions, daily fact, revenue KPIs and cohorts."""
