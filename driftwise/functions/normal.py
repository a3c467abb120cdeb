"""Quantile of the standard normal distribution as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rational approximations of the published algorithm AS 241 (Wichura 1988),
# lowest power first. The center serves |p - 0.5| <= 0.425, the tails the rest down to e^-25.
CENTER_OVER = (
    3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
    4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3,
)
CENTER_UNDER = (
    1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
    2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3,
)
TAIL_OVER = (
    1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
    1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4,
)
TAIL_UNDER = (
    1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
    1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9,
)


def _polynomial(coefficients: tuple[float, ...], x: Column) -> Column:
    value = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        value = F.lit(c) + x * value
    return value


def normal_quantile(p: Column) -> Column:
    """z with P(Z <= z) = p, to double precision, for p within (e^-25, 1 - e^-25)."""
    q = p - 0.5
    near = F.lit(0.180625) - q * q
    far = F.sqrt(-F.log(F.least(p, 1.0 - p))) - 1.6
    center = q * _polynomial(CENTER_OVER, near) / _polynomial(CENTER_UNDER, near)
    tail = F.signum(q) * _polynomial(TAIL_OVER, far) / _polynomial(TAIL_UNDER, far)
    return F.when(F.abs(q) <= 0.425, center).otherwise(tail)
