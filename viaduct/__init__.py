"""viaduct: Spark jobs that turn timetable feeds, airports and emission factors into comparable journeys."""
