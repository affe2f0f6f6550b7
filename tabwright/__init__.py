"""tabwright: supervised work on labelled tables, expressed as Spark jobs."""
