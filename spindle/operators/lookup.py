"""User -> roles lookup: `users.username = ?` joined to `user_roles` on userid.

The point predicate is a DataFrame filter, so it reaches the scan (parquet
`PushedFilters`, or the WHERE clause of a JDBC query). The filtered users
side is one row per matching name; AQE sees its runtime size and broadcasts it.
The password column is never selected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def roles_of_user(users: DataFrame, user_roles: DataFrame, username: str) -> DataFrame:
    u = users.filter(F.col("username") == F.lit(username)).select("userid", "username")
    return u.join(user_roles.select("userid", "role"), "userid").select("username", "role")
