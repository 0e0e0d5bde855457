"""DataFrame -> DataFrame building blocks. They take column names, so the same
function serves the enrolment schema and any other table."""
